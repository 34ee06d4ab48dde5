import random
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from likewise.llm import simhash_dedup as S

from .helpers import awkward, documents, vocabulary


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, max_bits):
    fps, group = sorted(set(fps)), {}
    for f in fps:
        near = {group[g] for g in group if (f ^ g).bit_count() <= max_bits}
        group[f] = f
        for g in group:
            if group[g] in near:
                group[g] = f
    return group


def test_fingerprint_is_the_plain_definition():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 500):
        text = "".join(w + rng.choice([" ", "\n", " x\t", "  "]) for w in vocabulary(rng, n)).upper()
        assert S.text_fingerprint(text.encode()) == brute_fingerprint(text)


def test_spark_hash_is_the_same_xxh64(spark):
    text = "ünïcode words of more than thirty-two bytes"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] == S._signed(
        xxhash.xxh64_intdigest(text.encode(), 42))


def near_fingerprints(rng, n):
    out = []
    for _ in range(n):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            out.append(base)
            for _ in range(rng.randint(0, 3)):
                base ^= 1 << rng.randrange(64)
    return out


def check_links(spark, fps, max_bits, max_bucket):
    rows = spark.createDataFrame([(i, S._signed(f)) for i, f in enumerate(fps)], "id bigint, fp bigint")
    got = {r.fp & S._ALL: r.component_id
           for r in S.label_components(rows, max_bits, max_bucket).collect()}
    groups = brute_groups(fps, max_bits)
    lowest = {}
    for i, f in enumerate(fps):
        lowest.setdefault(groups[f], i)
    assert got == {f: lowest[g] for f, g in groups.items()}


def test_components_equal_brute_force(spark):
    rng = random.Random(2)
    for max_bits in (1, 2, 3):
        check_links(spark, near_fingerprints(rng, 60), max_bits, S.MAX_BUCKET)


def test_over_full_variants_lose_no_link(spark):
    rng = random.Random(3)
    shared = rng.getrandbits(32)  # one half shared by all: every fingerprint is in hot variants
    fps = [shared | rng.getrandbits(32) << 32 for _ in range(150)]
    fps += [f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in fps[:60]]
    check_links(spark, fps + near_fingerprints(rng, 20), 2, 20)
    check_links(spark, fps, 2, S.MAX_BUCKET)


def test_long_chains_become_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 70)] + [(200, 190), (190, 180)], "a bigint, b bigint")
    got = {r.node: r.root for r in S.connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(71)}, 200: 180, 190: 180, 180: 180}


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [tuple(r) for r in S.near_duplicates(docs).collect()]
    assert len(rows) == docs.count()
    zero = [r for r in rows if r[1] == "0" * 16]
    assert Counter(r[0] for r in zero) == Counter([1, 2, 3, None]) and {r[2] for r in zero} == {1}
    assert [r[2] for r in rows if r[0] == 5].count(5) == 3 or len({r[1] for r in rows if r[0] == 5}) == 2
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    texts = Counter(r.text for r in kept.collect())
    assert texts["one two three"] == 1 and sum(t is None or not t.strip() for t in texts) == 1
    assert kept.filter("text is null").first().doc_id == 1


def test_empty_table(spark):
    docs = documents(spark, [])
    assert S.near_duplicates(docs).count() == 0 and S.drop_near_duplicates(docs).count() == 0


def test_ids_all_null_keep_one(spark):
    docs = documents(spark, [(None, "same words here", None, None)] * 3)
    assert S.drop_near_duplicates(docs).count() == 1
    assert [r.component_id for r in S.near_duplicates(docs).collect()] == [None] * 3
