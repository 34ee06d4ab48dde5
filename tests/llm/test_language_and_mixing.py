import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import xxhash
import zstandard

from likewise.llm import language_id as L, mixing as M

from .helpers import awkward, documents, vocabulary


def corpus(spark, n=400):
    rng = random.Random(8)
    parts = {"xx": "ka lo mi nu ta".split(), "yy": "schr ung pf ein ß".split(), "zz": "ción ñor ella que".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(60))
        rows.append((i, text, lang if i % 40 else "yy", "s"))  # some labels are wrong
    return documents(spark, rows), rows


def test_held_out_accuracy(spark):
    docs, rows = corpus(spark)
    model = L.fit(docs.filter(~L.held_out()))
    found = {r.doc_id: r for r in L.identify(docs, model, columns=["doc_id"]).select("row.*", "lang_pred", "score", "rejected").collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert [r[0] for r in docs.filter(L.held_out()).select("doc_id").orderBy("doc_id").collect()] == [r[0] for r in held]
    right = [found[r[0]].lang_pred == r[2] for r in held]
    assert sum(right) / len(right) >= 0.9
    assert all(0 <= r.score <= 1 for r in found.values())
    assert not any(found[r[0]].rejected for r in held)


def spark_hash(doc_id, text):
    """Spark's xxhash64 of a long and a text, from the plain function."""
    seed = 42 if doc_id is None else xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest()
    return xxhash.xxh64(text.encode(), seed=seed).intdigest()


def plain_letters(text):
    runs, run = [], ""
    for c in text or "":
        if c.isalpha():
            run += c
        elif run:
            runs, run = [*runs, run], ""
    runs += [run] if run else []
    return f" {' '.join(runs).lower()} ".encode() if runs else b""


def plain_sizes(samples, data, level):
    """Bytes of the blocks of a text behind each language's sample."""
    sizes = {}
    for lang, sample in samples.items():
        dictionary = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=level)
        pack = zstandard.ZstdCompressor(dict_data=dictionary, level=level, write_content_size=False,
                                        write_checksum=False, write_dict_id=False)
        sizes[lang] = sum(len(pack.compress(data[i:i + L.BLOCK_BYTES])) for i in range(0, len(data), L.BLOCK_BYTES))
    return sizes


def plain_verdict(samples, text):
    data = plain_letters(text)
    if not data or not samples:
        return "und", 0.0
    sizes = plain_sizes(samples, data, L.LEVEL)
    best = sorted((n, lang) for lang, n in sizes.items())
    if len(best) > 1 and best[0][0] == best[1][0]:
        finer = plain_sizes(samples, data, L.TIE_LEVEL)
        best = sorted((n + finer[lang], lang) for n, lang in best)
    return best[0][1], 1 - best[0][0] / best[1][0] if len(best) > 1 else 1.0


def plain_samples(rows):
    """The sample texts of each language, by plain loops."""
    of = {}
    for i, text, lang, _ in rows:
        if lang is not None and any(c.isalpha() for c in text or ""):
            of.setdefault(lang, []).append((spark_hash(i, text), text))

    def samples(texts):
        return {n: b"".join(dict.fromkeys(map(plain_letters, x)))[:L.DICTIONARY_BYTES] or b" " * 8 for n, x in texts.items()}

    drawn = {}
    for lang, texts in of.items():
        fits = [(draw, t) for draw, t in texts if len(t.encode()) <= L.DICTIONARY_BYTES]
        share = min(1.0, 2.0 * L.DOCS_PER_LANGUAGE / max(len(fits), 1))
        signed = lambda d: d - (1 << 64) if d >> 63 else d
        order = sorted((d % (1 << 30) / (1 << 30), signed(d), t) for d, t in fits if d % (1 << 30) / (1 << 30) < share)
        kept, size = [], 0
        for _, _, t in order[:L.DOCS_PER_LANGUAGE]:
            size += len(t.encode())
            if size <= 3 * L.DICTIONARY_BYTES:
                kept.append(t)
        drawn[lang] = kept
    halves = [{n: x[k::2] for n, x in drawn.items()} for k in (0, 1)]
    sure = {n: [] for n in drawn}
    for half, other in (halves, halves[::-1]):
        judges = samples(other)
        for n, own in half.items():
            for t in own:
                lang, score = plain_verdict(judges, t)
                if lang == n and score >= L.CONFIRM_MARGIN:
                    sure[n].append(t)
    return samples({n: sure[n] or drawn[n] for n in drawn})


def test_language_equals_plain_compression(spark):
    docs, rows = corpus(spark, 150)
    rows += [(1000, None, "xx", None), (1001, "½ ² 12 Ⅷ", "yy", None), (1002, "Ünïcode ½ñ 東京", None, "s"),
             (None, rows[0][1], "xx", None), (1003, rows[0][1] * 40, None, None)]
    docs = documents(spark, rows)
    train = [r for r in rows if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5]
    samples = plain_samples(train)
    model = L.fit(docs.filter(~L.held_out()))
    assert dict(zip(model.names, model.samples)) == samples
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in L.identify(docs, model).select("row.*", "lang_pred", "score").collect()}
    for i, text, _, _ in rows:
        lang, score = plain_verdict(samples, text)
        assert got[i, text][0] == lang and abs(got[i, text][1] - score) < 1e-12


def test_number_signs_are_no_letters():
    assert L.normalise("½ ² Ⅷ _ 7 ٣ \u0301") == b"" and L.normalise("a½b Ⅷc") == b" a b c "


def test_language_of_awkward_rows(spark):
    docs, _ = corpus(spark, 200)
    model = L.fit(docs)
    rows = L.identify(awkward(spark), model).select("row.*", "lang_pred", "score", "rejected").collect()
    assert len(rows) == 9
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.rejected)
    same = {(r.lang_pred, r.score) for r in rows if r.text == "one two three"}
    assert len(same) == 1
    assert L.keep_identified(awkward(spark), model).columns == awkward(spark).columns


def test_language_without_training_rows(spark):
    model = L.fit(documents(spark, []))
    assert {r.lang_pred for r in L.identify(awkward(spark), model).collect()} == {"und"}
    assert L.identify(documents(spark, []), model).count() == 0


def uniform(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 16 ** 13


def poisson(mean, u):
    p = c = math.exp(-mean)
    k = 0
    while c <= u and k < 400:
        k += 1
        p *= mean / k
        c += p
    return k


def test_copies_equal_plain_inversion(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(vocabulary(rng, 20)), "en", f"s{min(i % 9, 3)}") for i in range(500)]
    weights = {"s0": 30.0, "s1": 1.0, "s2": 0.0, "s3": 5.0}
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(text)
    given = sum(weights.values())
    rates = {s: weights[s] * sum(sizes.values()) / (given * sizes[s]) for s in sizes}
    docs = documents(spark, rows)
    got = Counter(r[0] for r in M.copies(docs, weights, columns=["doc_id"]).select("row.doc_id").collect())
    assert got == Counter({i: n for i, _, _, s in rows if (n := poisson(rates[s], uniform(M.SEED, 1, i)))})
    mixed = M.mix_sources(docs, weights)
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == got


def test_large_rates_are_sums_of_parts(spark):
    rows = [(i, "word", "en", "big" if i % 100 == 0 else "rest") for i in range(2000)]
    docs = documents(spark, rows)
    got = Counter(r[0] for r in M.copies(docs, {"big": 1.0}, columns=["doc_id"]).select("row.doc_id").collect())
    rate, parts = 100.0, 4
    assert got == Counter({i: sum(poisson(rate / parts, uniform(M.SEED, p, i)) for p in range(1, parts + 1))
                           for i in range(0, 2000, 100)})


def test_mixing_awkward_rows(spark):
    docs = awkward(spark)
    mixed = M.mix_sources(docs)
    assert mixed.columns == docs.columns and set(mixed.collect()) <= set(docs.collect())
    rates = {r.source: r.rate for r in M.source_rates(docs).collect()}
    assert set(rates) == {None, "s", "t"}
    assert M.mix_sources(documents(spark, [])).count() == 0
    same = Counter(r for r in mixed.collect() if r.doc_id == 5 and r.text == "one two three")
    assert not same or min(same.values()) % 2 == 0


def test_rows_without_an_id_draw_by_their_text(spark):
    """A third of the rows has no id; they must not all draw one number."""
    rows = [(None if i % 3 == 0 else i, f"some text number {i}", "en", "a" if i % 2 else "b") for i in range(900)]
    docs = documents(spark, rows)
    copies = M.copies(docs, {"a": 1.0, "b": 1.0}, columns=["text"]).select("row.text", "shuffle_key").collect()
    counts = Counter(r.text for r in copies if int(r.text.split()[-1]) % 3 == 0)
    assert len(set(counts.values())) > 1 and 100 < len(counts) < 300 and 200 < sum(counts.values()) < 400
    assert len({r.shuffle_key for r in copies}) == len(copies)
