"""SimHash: fingerprints and components against plain Python, crowded keys included."""

import random

import pytest
import xxhash

from retailtide.llm import simhash
from retailtide.llm.queries import QUERIES


def plain_fingerprint(text, words=3):
    parts = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        parts = parts.replace(blank, " ")
    parts = [w for w in parts.split(" ") if w]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=3):
    """prints: (key, fingerprint); the smallest key of each one's component."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    values = sorted({f for _, f in prints})
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for key, value in prints:
        least[find(value)] = min(least.get(find(value), key), key)
    return {key: least[find(value)] for key, value in prints}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_given_documents(spark, small_dir, given):
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op2_simhash"](spark, small_dir).collect()}
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in given.collect()]
    groups = plain_components(prints)
    assert found == {i: (f"{f:016x}", groups[i]) for i, f in prints}


def balls(seed, centres, members, bits):
    draw = random.Random(seed)
    values = set()
    for _ in range(centres):
        centre = draw.getrandbits(64)
        for _ in range(members):
            value = centre
            for b in draw.sample(range(64), draw.randint(0, bits)):
                value ^= 1 << b
            values.add(value)
    return sorted(values)


@pytest.mark.parametrize("crowd", [1024, 64])
def test_links_are_all_pairs_within_three_bits(spark, crowd):
    values = balls(5, 3, 150, 3)
    frame = simhash.stored(spark.createDataFrame([(signed(v),) for v in values], "fingerprint bigint"), "test")
    # under the low limit keys are divided
    found = {(r["a"], r["b"]) for r in simhash.links(frame, 3, crowd).collect()}
    whole = [(signed(a), signed(b)) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 3]
    assert found == {(min(p), max(p)) for p in whole} and len(found) > 100


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(100)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    ring = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    edges = spark.createDataFrame(path + star + ring + star, "a bigint, b bigint")
    roots = {r["vertex"]: r["root"] for r in simhash.components(edges).collect()}
    assert len(roots) == 101 + 300 + 50
    assert len({roots[v] for v in range(101)}) == len({roots[v] for v in range(1000, 1300)}) == len({roots[v] for v in range(2000, 2050)}) == 1
    assert len(set(roots.values())) == 3
    assert simhash.components(edges.limit(0)).count() == 0


def test_edge_rows(spark, documents):
    long = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
    rows = documents((5, None), (3, ""), (9, " \t\n"), (None, long), (7, long), (7, long), (8, "One two"), (2, "one  TWO"))
    found = simhash.near_copies(rows.withColumn("id", rows["lang"]).withColumn("fingerprint", rows["lang"])).collect()
    got = sorted(((r["doc_id"], r["component_id"]) for r in found), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (None, 7), (7, 7), (7, 7), (8, 2), (2, 2)], key=str)
    assert simhash.near_copies(documents()).count() == 0
    assert sorted(r["doc_id"] for r in simhash.one_of_each(rows).collect()) == [2, 3, 7]
    assert simhash.one_of_each(rows).columns == rows.columns


def test_labels_are_the_same_wherever_they_meet_their_rows(documents, monkeypatch):
    rows = [(i, "one text of a third of all" if i % 3 == 0 else f"own words number {i} stand here {i * 7}") for i in range(90)]
    rows += [(200, None), (201, ""), (None, "alone"), (5, "again"), (5, "again")]
    found = []
    for hot in (1, 8, 1 << 20):
        monkeypatch.setattr(simhash, "HOT_CLASSES", hot)
        found.append(sorted(map(str, simhash.near_copies(documents(*rows)).collect())))
    assert len(found[0]) == len(rows) and found[0] == found[1] == found[2]


def test_the_plan_of_components_does_not_grow_with_the_rounds(spark):
    joins = []
    for length in (4, 400):
        edges = spark.createDataFrame([(i, i + 1) for i in range(length)], "a bigint, b bigint")
        roots = simhash.components(edges)
        joins.append(roots._jdf.queryExecution().optimizedPlan().toString().count("Join"))
        assert roots.select("root").distinct().count() == 1 and roots.count() == length + 1
    assert max(joins) <= 1
