from orderlens.llm.components import components


def test_chain_star_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (None, 5)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    want = {i: 0 for i in range(61)} | {100: 100} | {k: 100 for k in range(101, 160)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
