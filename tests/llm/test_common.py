import random

import corpora
import pytest
from punctua.llm import common


@pytest.mark.parametrize("kind", ["path", "random", "star", "none"])
def test_components_match_brute_force(spark, kind):
    rng = random.Random(25)
    order = list(range(120))
    rng.shuffle(order)
    links = {
        "path": [(order[i], order[i + 1]) for i in range(90)],
        "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(70)],
        "star": [(order[0], order[i]) for i in range(1, 100)] + [(5, 5)],
        "none": [],
    }[kind]
    found = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = corpora.components(120, links)
    touched = {i for a, b in links for i in (a, b) if a != b}
    assert found == {i: expected[i] for i in touched}


def test_running_sum_over_ranges(spark):
    rng = random.Random(26)
    data = [(rng.choice([1, 2, None]), rng.randrange(40), i, rng.randrange(9)) for i in range(400)]
    df = spark.createDataFrame(data, "g int, k int, id int, v int").repartition(6)
    found = {r.id: r.total for r in common.running_sum(df, "g", ["k", "id"], "v", "total").collect()}
    for group in (1, 2, None):
        total = 0
        for _, k, i, v in sorted((r for r in data if r[0] == group), key=lambda r: (r[1], r[2])):
            total += v
            assert found[i] == total


def test_word_hashes_stay_bounded():
    hashes = common.WordHashes()
    hashes.LIMIT = 10
    words = [str(i).encode() for i in range(100)]
    assert hashes.of(words).tolist() == [common.xxhash.xxh3_64_intdigest(w) for w in words] and len(hashes) <= 10
