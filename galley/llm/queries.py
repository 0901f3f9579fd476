"""One query per operator over its whole table, with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm import alignment, forest, infill, jaccard, language, lattice, neardup, packing, pii, repeats, unigram, url_lists, warc
from galley.llm.common import table

ORACLES: dict[str, str] = {}


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seen = docs.filter(~language.held_out(F.col("doc_id")))
    model = language.fit(seen, F.col("doc_id"))
    answers = language.identify(docs, model, ["doc_id"])
    return answers.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), ["doc_id"])

    def of_kind(k: int):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), ["doc_id"], tokenizer_file("word_bpe_49k.json"), with_ids=False
    )


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), ["doc_id"]).drop("kept")


def op3_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "embeddings"), ["vec_id"])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )


#: ``sha1`` and byte lengths of DuckDB are those of UTF-8, as in the archives.
ORACLES["op5_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS bytes FROM pages
), b AS (
  SELECT payload, max(page_id) AS best FROM p WHERE bytes >= 1000 GROUP BY payload
)
SELECT page_id, bytes AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN best IS NOT NULL AND page_id IS DISTINCT FROM best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN best IS NOT NULL AND page_id IS DISTINCT FROM best THEN best END AS refers_to
FROM p LEFT JOIN b ON p.payload = b.payload
"""


def capture_times(pages: DataFrame) -> DataFrame:
    """Pages as captures: the id gives the minute of a year in which a page was fetched."""
    minute = F.pmod(F.col("page_id") * 7919, F.lit(525_600))
    return pages.select("page_id", "url", (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=minute)).alias("fetched_at"))


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list events that the pages imply: two of seven pages put an address on a list or take one off.

    Ids decide all of it, so the lists grow with the pages and SQL can say the same.
    """
    n, host, path = F.col("page_id"), url_lists.host_of(F.col("url")), url_lists.path_of(F.col("url"))
    minute = F.pmod(n * 104_729 + 17, F.lit(525_600))
    return pages.filter((n % 7).isin(0, 1) & host.isNotNull()).select(
        F.when(n % 3 == 0, "adult").when(n % 3 == 1, "malware").otherwise("spam").alias("list"),
        F.when(n % 2 == 0, "domain").otherwise("prefix").alias("kind"),
        F.when(n % 2 == 0, host).otherwise(F.concat(host, F.lit("/"), F.split(path, "/")[0])).alias("value"),
        F.when(n % 7 == 0, "add").otherwise("remove").alias("action"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=minute)).alias("at"),
    )


def op1_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.evaluate(capture_times(pages), list_events(pages), ["page_id"])


ORACLES["op1_url_lists"] = r"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS authority,
         trim(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') AS path,
         (page_id * 7919) % 525600 AS fetched
  FROM pages
), c AS (
  SELECT page_id, fetched, path,
         regexp_replace(regexp_replace(regexp_replace(authority, '^.*@', ''), ':[0-9]*$', ''), '\.$', '') AS host
  FROM p
), e AS (
  SELECT CASE page_id % 3 WHEN 0 THEN 'adult' WHEN 1 THEN 'malware' ELSE 'spam' END AS list,
         page_id % 2 AS prefix,
         CASE WHEN page_id % 2 = 0 THEN host ELSE host || '/' || split_part(path, '/', 1) END AS value,
         page_id % 7 = 0 AS adds, (page_id * 104729 + 17) % 525600 AS moment
  FROM c WHERE page_id % 7 IN (0, 1) AND host <> ''
), latest AS (
  SELECT c.page_id, e.list, e.prefix, e.value, max(e.moment) AS moment
  FROM c JOIN e ON e.moment <= c.fetched
   AND CASE WHEN e.prefix = 0 THEN c.host = e.value OR ends_with(c.host, '.' || e.value)
            ELSE c.path <> '' AND starts_with(c.host || '/' || c.path || '/', e.value || '/') END
  WHERE c.host <> ''
  GROUP BY ALL
), active AS (
  SELECT list, prefix, value, moment FROM e GROUP BY ALL HAVING bool_and(adds)
), hits AS (
  SELECT page_id, count(*) AS n_entries, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
  FROM latest JOIN active USING (list, prefix, value, moment) GROUP BY page_id
)
SELECT page_id, coalesce(n_entries, 0) AS n_entries, coalesce(lists, '') AS lists FROM c LEFT JOIN hits USING (page_id)
"""


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = unigram.vocabulary(tokenizer_file("piece_bpe_32k.model"))
    return unigram.count_pieces(table(spark, sf_dir, "documents"), ["doc_id"], words)


def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = unigram.vocabulary(tokenizer_file("piece_bpe_32k.model"))
    return lattice.encode(table(spark, sf_dir, "documents"), ["doc_id"], words, with_decoded=True).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = infill.transform(table(spark, sf_dir, "documents"), ["doc_id"])
    return written.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op11_infill"] = """
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || doc_id) AS digits
  FROM documents
), h AS (
  SELECT *, len(units) AS n, ('0x' || digits[1:8])::UBIGINT AS h1, ('0x' || digits[9:16])::UBIGINT AS h2,
         ('0x' || digits[17:24])::UBIGINT AS h3, ('0x' || digits[25:32])::UBIGINT AS h4
  FROM u
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as one, open(tokenizer_file("piece_bpe_32k.model"), "rb") as other:
        told = alignment.agreement(table(spark, sf_dir, "documents"), ["doc_id"], one.read(), other.read())
    return told.withColumnRenamed("groups", "groups_sha256")


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.without_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_url_lists": op1_url_lists,
    "op2_pii": op2_pii,
    "op3_forest": op3_forest,
    "op4_language": op4_language,
    "op5_warc": op5_warc,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_jaccard": op8_jaccard,
    "op9_neardup": op9_neardup,
    "op10_lattice": op10_lattice,
    "op11_infill": op11_infill,
    "op12_alignment": op12_alignment,
    "op13_repeats": op13_repeats,
}
