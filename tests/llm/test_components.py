import random

from unionfind import roots

from recordtable.llm.components import connected_components


def check(spark, links):
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == roots({x for ab in links for x in ab}, links)


def test_random_chain_star_and_odd_rows(spark):
    rng = random.Random(5)
    links = [(rng.randrange(900), rng.randrange(900)) for _ in range(480)]
    links += [(i, i + 1) for i in range(2000, 2060)] + [(3000, 3000 + i) for i in range(1, 80)]
    links += [(7, 7), (None, 3), (4, None), (1, 2), (2, 1), (1, 2), (-5, 12)]
    check(spark, links)


def test_no_links(spark):
    check(spark, [])
