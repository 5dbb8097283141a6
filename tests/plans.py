"""What Spark's plans did while something ran."""

import re


class Broadcasts:
    """``with Broadcasts(spark) as seen: ...`` fills ``seen.columns``: those of each frame that was broadcast."""

    def __init__(self, spark):
        self.statuses = spark._jsparkSession.sharedState().statusStore()
        self.bus = spark.sparkContext._jsc.sc().listenerBus()

    def _executions(self):
        self.bus.waitUntilEmpty(30_000)
        found = self.statuses.executionsList()  # only the last thousand are kept
        found = [found.apply(i) for i in range(found.size())]
        return {e.executionId(): e for e in found}

    def __enter__(self):
        self.before = self._executions().keys()
        return self

    def __exit__(self, *_):
        plans = [e.physicalPlanDescription() or "" for i, e in self._executions().items() if i not in self.before]
        self.columns = re.findall(r"\) BroadcastExchange\s+Input \[\d+\]: \[(.*)\]", "\n".join(plans))
