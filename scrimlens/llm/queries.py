"""The registered queries of the corpus operators, with their production parameters, and their SQL where SQL has words for them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrimlens.llm.bpe import encode_documents
from scrimlens.llm.exact import exact_dedup
from scrimlens.llm.fingerprint import neighbour_fingerprints
from scrimlens.llm.html_text import extract
from scrimlens.llm.language import identify
from scrimlens.llm.licences import scan
from scrimlens.llm.ngram_join import near_classes
from scrimlens.llm.packing import pack
from scrimlens.llm.periodic import periodic_runs
from scrimlens.llm.secrets import find_secrets
from scrimlens.llm.substrings import span_digests
from scrimlens.llm.toxicity import toxicity
from scrimlens.llm.whiten import whitening


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir), keep="max")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(_documents(spark, sf_dir), size=5, share=75, of=100)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=2048)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return identify(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), held_out)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(_documents(spark, sf_dir), window=20).drop("spans")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents carry no paths: each is taken as the file source/thousand/fifty/id, so that a source is a tree of directories."""
    number = F.col("doc_id")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.floor(number / 1000).cast("string"), F.floor(number / 50).cast("string"), number.cast("string"))
    return scan(_documents(spark, sf_dir), path)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(_documents(spark, sf_dir))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_documents(spark, sf_dir))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=16)
    by_component = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "c")
    return found.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", by_component).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


def _repeating(docs: DataFrame) -> DataFrame:
    """Every tenth document, chosen by a checksum of its id, repeats a stretch of its words from some word on to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, n = F.col("words"), F.col("n")
    hit = docs.withColumn("_h", h).withColumn("_hit", F.coalesce(F.col("_h") % 10 == 0, F.lit(False)))
    split = hit.withColumn("words", F.when(F.col("_hit"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))))
    g = F.floor(F.col("_h") / 10)
    sized = split.withColumn("n", F.coalesce(F.size("words"), F.lit(0))).withColumn("a", F.when(n > 0, g % n).otherwise(0).cast("int"))
    period = (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, F.col("a") + 1, F.col("p")), F.ceil((n - F.col("a")) / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), n - F.col("a"))), " ")
    return sized.withColumn("p", period).select("doc_id", F.when(F.col("_hit") & (n > 0), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_repeating(_documents(spark, sf_dir).select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_exact_dedup, op2_ngram_join, op3_packing, op4_language, op5_byte_bpe, op6_substring_dedup, op7_toxicity, op8_licences,
        op9_html_text, op10_fingerprints, op11_secrets, op12_whitening, op13_periodic_runs)
}

_WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"
#: Checksum of a text of ASCII characters: each byte enters, then eight steps of the usual polynomial follow (-1).
_CRC = (
    "xor(list_reduce([4294967295::UBIGINT::HUGEINT] || flatten([[unicode(c)::HUGEINT] || [(-1)::HUGEINT FOR _ IN range(8)] FOR c IN string_split({text}, '')]), "
    "lambda r, x: CASE WHEN x >= 0 THEN xor(r::UBIGINT, x::UBIGINT)::HUGEINT WHEN r % 2 = 1 THEN xor((r // 2)::UBIGINT, 3988292384::UBIGINT)::HUGEINT "
    "ELSE r // 2 END)::UBIGINT, 4294967295::UBIGINT)::BIGINT")
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op2_ngram_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_FOLDED)} AS words FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, greatest(len(words) - 4, 1) + 1)]) AS gram
              FROM w WHERE len(words) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (gram)
                  WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
                  WHERE 100 * k >= 75 * (p.n + q.n - k)),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached AS (SELECT doc_id AS x, doc_id AS y FROM documents
                    UNION SELECT r.x, l.y FROM reached r JOIN both_ways l ON l.x = r.y)
        SELECT r.x AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
        FROM reached r LEFT JOIN sizes ON sizes.doc_id = r.x GROUP BY r.x""",
    "op6_substring_dedup": f"""
        WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
        places AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS i,
                          unnest([array_to_string(words[i:i + 19], ' ') FOR i IN range(1, len(words) - 18)]) AS run FROM w WHERE len(words) >= 20),
        found AS (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1 AS later FROM places),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM found WHERE later),
        single AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM w WHERE len(words) > 0),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text FROM single ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id),
        removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM w LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op13_periodic_runs": f"""
        WITH own AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words, {_CRC.format(text="doc_id::VARCHAR")} AS h FROM documents),
        sized AS (SELECT doc_id, words, len(words) AS n, h, h // 10 AS g FROM own),
        chosen AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
        cycled AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM chosen),
        w AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN words
                     ELSE [words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)] END AS words FROM cycled),
        t AS (SELECT doc_id, n, unnest(words) AS word, unnest(range(n)) AS i FROM w),
        equal AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word
                  AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        lots AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS lot FROM equal),
        stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM lots GROUP BY doc_id, q, lot
                      HAVING count(*) + q >= greatest(6, 4 * q)),
        runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
        best AS (SELECT doc_id, start, length, period FROM runs
                 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
        listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
                   FROM runs GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT w.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
               (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
               sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM w LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
