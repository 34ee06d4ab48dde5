"""The registered queries of this subpackage, each over its whole table, and
their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (decontaminate, hard_negatives, host_reputation, language_id, line_quality, line_templates,
               merkle_manifest, mixing, packing, quote_links, secret_scan, simhash_dedup, token_output)
from .common import table

# The fixed url rules: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs).select(
        "row.doc_id", "text", "n_lines", "n_dropped")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), columns=["doc_id"])
    base = [r.kind for r in secret_scan.BASE_RULES]
    digest = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(
        "spans", lambda s: s["kind"] == kind)).cast("bigint")
    of_base = F.filter("spans", lambda s: s["kind"].isin(*base))
    return found.select(
        "row.doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(digest(of_base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"),
                                             columns=["doc_id"])
    m = F.col("match")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), m["n_words"].alias("n_words"),
        m["n_hit"].alias("n_hit"), F.size(m["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(m["items"], ","), 256).alias("items_sha256"),
        m["contaminated"].alias("contaminated"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_table(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled outcomes are the labels of the same id: a page is bad if toxic or
    of quality 0."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.when(
        (F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0).alias("bad"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return host_reputation.judge_urls(pages, outcomes, URL_RULES).select(
        "row.page_id", "host", "path", "rule", "verdict", "n", "bad", F.round("mean", 6).alias("mean"),
        F.round("low", 6).alias("low"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy drawn, with its place in the global order and the digest of its text as it
    came through the shuffle."""
    copies = mixing.copies(table(spark, sf_dir, "documents"), columns=["doc_id", "text"])
    dealt = copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return dealt.select("row.doc_id", "source", "copy", "shuffle_key", F.md5("row.text").alias("text_md5"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~language_id.held_out()))
    found = language_id.identify(docs, model, columns=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score", "rejected").select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op9_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations hold no quotes, so every message of an odd turn quotes the one of
    the turn before, and every fourth also what stands two turns before, one level deeper."""
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(
        F.min("text").alias("said"))

    def before(n: int, name: str) -> DataFrame:
        return said.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("said").alias(name))

    def quoted(text: str, sign: str):
        return F.concat(F.lit(sign), F.replace(F.col(text), F.lit("\n"), F.lit("\n" + sign)))

    both = messages.join(before(1, "one"), ["conv_id", "turn"], "left").join(
        before(2, "two"), ["conv_id", "turn"], "left")
    text = F.when((F.col("turn") % 4 == 3) & F.col("one").isNotNull() & F.col("two").isNotNull(), F.concat_ws(
        "\n", quoted("two", ">> "), quoted("one", "> "), F.lit(""), "text")).when(
        (F.col("turn") % 2 == 1) & F.col("one").isNotNull(),
        F.concat_ws("\n", F.lit("They wrote:"), quoted("one", "> "), F.lit(""), "text")).otherwise(F.col("text"))
    return quote_links.reply_ordered(both.select("conv_id", "turn", "role", text.alias("text")))


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_quality.judge(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return found.select("row.doc_id", *[F.col("quality")[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh vector has the next label; components are whole 256ths."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table(spark, sf_dir, "embeddings").filter(finite).select(
        F.col("vec_id").alias("id"), label.cast("bigint").alias("label"), whole.alias("vector"))
    return hard_negatives.mine(rows, F.col("id") % 50 == 0)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(packing.pack(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("word_bpe_49k.json")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 5 divides the crc32 of the id, the candidate leaf has its text's A-Z lower-cased."""
    names = ["doc_id", "source", "lang", "n_chars"]
    values = [F.col(n) for n in names]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    candidate = F.when(tampered, merkle_manifest.leaf_digest(*values, lower))
    found = merkle_manifest.manifest(table(spark, sf_dir, "documents"), [*values, F.col("text")],
                                     candidate=candidate)
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256",
                        "folded_root", "verified")


QUERIES = {
    "op1_line_templates": op1_line_templates,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_token_output": op4_token_output,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_host_reputation": op6_host_reputation,
    "op7_mix_sources": op7_mix_sources,
    "op8_language_id": op8_language_id,
    "op9_quote_links": op9_quote_links,
    "op10_line_quality": op10_line_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_packing": op12_packing,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def mix_sources_sql() -> str:
    top = 16 ** 13
    uniform = "(CAST('0x' || substr(md5({}), 1, 13) AS BIGINT) / {}.0)"
    key = "coalesce(CAST(doc_id AS VARCHAR), concat_ws(':', 'null', md5(text)))"
    draw = uniform.format(f"concat_ws(':', '{mixing.SEED}', '1', {key})", top)
    order = uniform.format(f"concat_ws(':', '{mixing.SEED}', 'order', {key}, coalesce(md5(text), 'null'), "
                           "CAST(copy AS VARCHAR))", top)
    return f"""WITH RECURSIVE sizes AS (
  SELECT source, CAST(coalesce(sum(length(text)), 0) AS DOUBLE) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN size = 0 THEN 1.0
         ELSE pow(size, {mixing.FLATTEN}) * (SELECT sum(size) FROM sizes)
              / ((SELECT sum(pow(size, {mixing.FLATTEN})) FROM sizes WHERE size > 0) * size) END AS rate
  FROM sizes),
cdf(source, rate, k, p, c) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf
  WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
drawn AS (
  SELECT d.doc_id, d.source, d.text, count(c.k) AS n
  FROM (SELECT row_number() OVER () AS r, doc_id, source, text, {draw} AS u FROM documents) d
  LEFT JOIN cdf c ON c.source IS NOT DISTINCT FROM d.source AND c.c <= d.u
  GROUP BY d.r, d.doc_id, d.source, d.text),
copies AS (
  SELECT doc_id, source, text, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy FROM drawn)
SELECT doc_id, source, copy, {order} AS shuffle_key, md5(text) AS text_md5 FROM copies"""


def quote_links_sql() -> str:
    quoted = "'{1}' || replace({0}, chr(10), chr(10) || '{1}')"
    source = f"""WITH said AS (
  SELECT conv_id, turn, min(text) AS said FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
  GROUP BY conv_id, turn)
SELECT c.conv_id, c.turn, c.role, CASE
  WHEN c.turn % 4 = 3 AND one.said IS NOT NULL AND two.said IS NOT NULL
    THEN concat_ws(chr(10), {quoted.format('two.said', '>> ')}, {quoted.format('one.said', '> ')}, '', c.text)
  WHEN c.turn % 2 = 1 AND one.said IS NOT NULL
    THEN concat_ws(chr(10), 'They wrote:', {quoted.format('one.said', '> ')}, '', c.text)
  ELSE c.text END AS text
FROM conversations c LEFT JOIN said one ON one.conv_id = c.conv_id AND one.turn = c.turn - 1
LEFT JOIN said two ON two.conv_id = c.conv_id AND two.turn = c.turn - 2"""
    return quote_links.reply_ordered_sql(f"({source})")


ORACLE_SQL = {
    "op1_line_templates": line_templates.templates_sql(),
    "op3_decontaminate": decontaminate.contamination_sql(),
    "op6_host_reputation": host_reputation.judge_sql(URL_RULES),
    "op9_quote_links": quote_links_sql(),
    "op10_line_quality": line_quality.quality_sql(),
    "op7_mix_sources": mix_sources_sql(),
    "op11_hard_negatives": hard_negatives.mine_sql(),
    "op13_merkle_manifest": merkle_manifest.manifest_sql(),
}
