"""Collects the queries and, where one exists, their SQL for the comparison."""

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    """Register ``fn(stand_ins) -> DataFrame`` under a name."""

    def keep(fn):
        from workload.standins import StandIns

        QUERIES[name] = lambda spark, sf_dir: fn(StandIns(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep
