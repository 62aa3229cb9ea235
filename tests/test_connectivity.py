from tarn.operators import connectivity

SCHEMA = "hydro_id long, from_node long, to_node long, next_down_id long"


def network(spark, links):
    return spark.createDataFrame([(i, i, n, n) for i, n in links], SCHEMA)


def test_paths_are_as_long_as_the_river_and_end_where_the_network_does(spark):
    river = [(i, i + 1) for i in range(1, 1500)] + [(1500, -1)]
    clipped = [(2001, 2002), (2002, 9999)]
    cycle = [(3001, 3002), (3002, 3003), (3003, 3002)]
    df = network(spark, [*river, (1800, 1400), *clipped, *cycle, (4001, -1)])
    got = {r["head"]: r["path"] for r in connectivity.reach_paths(df).collect()}
    assert got == {1: list(range(1, 1501)), 1800: [1800, *range(1400, 1501)], 2001: [2001, 2002], 4001: [4001]}
    assert connectivity.reach_paths(df.limit(0)).collect() == []


def test_cycles_are_violations(spark):
    found = lambda links: {r["check"]: r["n"] for r in connectivity.validate_topology(network(spark, links)).collect()}
    assert found([(1, 2), (2, 3), (3, 2), (4, 4), (5, -1)])["cycle"] == 3
    assert found([(1, 2), (2, 3), (3, -1), (4, 99)])["cycle"] == 0
