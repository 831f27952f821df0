"""One query for each operator, over whole tables, and the SQL that some must equal."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm import bpe_trie, conversation_repair, language_id, sentencepiece_tokens, toxicity, warc
from starflow.llm.decontamination import find_leaks
from starflow.llm.hard_negatives import hard_negatives
from starflow.llm.line_dedup import bitmap_counts, kept_text, with_bitmaps
from starflow.llm.minhash import near_duplicates
from starflow.llm.surrogates import pseudonymize
from starflow.llm.rows import documents
from starflow.llm.substring_dedup import remove_repeats
from starflow.llm.winnowing import edited_fingerprints
from starflow.sources import read_parquet

# A SentencePiece model file on the driver; its content goes to the tasks.
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# A tokenizers file with a BPE model, likewise.
BPE_TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _held_out(doc_id: str = "doc_id") -> Column:
    """Documents no classifier may learn from. Never NULL."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.drop("row")


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.as_responses(_table(spark, sf_dir, "pages")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~_held_out()))
    return language_id.identify(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "lang_pred", "score"
    )


def op4_pii_surrogates(
    spark: SparkSession, sf_dir: str, key: str = "not a secret"
) -> DataFrame:
    return pseudonymize(_table(spark, sf_dir, "documents"), key)


def _kept_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()))
        kept = [hashlib.sha256(kept_text(*row).encode()).hexdigest() for row in rows]
        counts = [bitmap_counts(keep, text) for text, keep in rows]
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "n_lines": pa.array([lines for lines, _ in counts], pa.int64()),
                "n_dropped": pa.array([dropped for _, dropped in counts], pa.int64()),
                "kept_sha256": pa.array(kept, pa.string()),
            }
        )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(_table(spark, sf_dir, "documents"))
    return with_bitmaps(docs).mapInArrow(
        _kept_digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels").filter(~_held_out()))
    return toxicity.toxicity(docs, model).select(
        "doc_id",
        _held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_sentencepiece(
    spark: SparkSession, sf_dir: str, model: str = SENTENCEPIECE_MODEL
) -> DataFrame:
    return sentencepiece_tokens.encode(
        _table(spark, sf_dir, "documents"), Path(model).read_bytes()
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = remove_repeats(_table(spark, sf_dir, "documents"), digest=True)
    return removed.withColumnRenamed("kept", "kept_sha256")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80).drop("row")


def op11_bpe_trie(spark: SparkSession, sf_dir: str, tokenizer: str = BPE_TOKENIZER) -> DataFrame:
    encoded = bpe_trie.encode(_table(spark, sf_dir, "documents"), Path(tokenizer).read_bytes(), decoded=True)
    ids_text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id", "n_tokens", F.sha2(ids_text, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", other), F.col("vec_id") % 100 == 0)


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """Rows of `conversations` dropped, emptied, stripped of full stops, repeated or given to the user, by their key."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv, turn, role, text = parts
    damage = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    return conversations.select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(role).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(damage == 0, F.array()).when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _repair_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and digest of each conversation, whose rows come one after the other."""
    conv, audit, digest, lines, begun, kind = None, [], hashlib.sha256(), 0, False, None

    def done() -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([conv], kind), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])],
            ["of_conv", "audit", "repaired_sha256"],
        )

    for batch in batches:
        kind = batch.column("conv_id").type
        for own, edit, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "edit", "role", "text")]):
            if not begun or own != conv:
                if begun:
                    yield done()
                conv, audit, digest, lines, begun = own, [], hashlib.sha256(), 0, True
            audit.append(edit)
            if len(audit) > 4096:
                audit = ["".join(audit)]
            if edit != "D":
                digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
    if begun:
        yield done()


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = _table(spark, sf_dir, "conversations")
    damaged = damaged_conversations(original)
    counts, edits = conversation_repair.diagnose(damaged)
    kind = dict(original.dtypes)["conv_id"]
    digests = conversation_repair.repaired(damaged, edits).mapInArrow(
        _repair_digests, f"of_conv {kind}, audit string, repaired_sha256 string"
    )
    counts = counts.withColumnRenamed("conv_id", "conv")
    every = original.select("conv_id").distinct()
    found = every.join(counts, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("of_conv")), "left"
    )
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_benchmark_decontamination": op1_benchmark_decontamination,
        "op2_warc_derivatives": op2_warc_derivatives,
        "op3_language_id": op3_language_id,
        "op4_pii_surrogates": op4_pii_surrogates,
        "op5_line_dedup": op5_line_dedup,
        "op6_winnowing": op6_winnowing,
        "op7_toxicity": op7_toxicity,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_bpe_trie": op11_bpe_trie,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_conversation_repair": op13_conversation_repair,
    }


# Words and blanks as the operators have them.
_BLANK = r"[\x20\x09-\x0D]"
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5_SQL = rf"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos FROM split),
keyed AS (
  SELECT *, {_LOWER.format(f"regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g')")} AS key
  FROM lines),
owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
judged AS (
  SELECT k.doc_id, k.line, k.pos, coalesce(o.owner = k.doc_id, true) AS kept
  FROM keyed k LEFT JOIN owners o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT kept) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (kept), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP9_SQL = f"""
WITH worded AS (SELECT doc_id, {_WORDS.format("text")} AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS start,
         unnest(list_transform(range(1, len(words) - 18),
                               lambda i: array_to_string(words[i:i + 19], ' '))) AS key
  FROM worded WHERE len(words) >= 20),
ranked AS (
  SELECT doc_id, start, row_number() OVER (PARTITION BY key ORDER BY doc_id, start) AS nth
  FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS pos FROM ranked WHERE nth > 1),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM worded),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.pos) AS text, count(*) AS n
  FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY p.doc_id)
SELECT w.doc_id, len(w.words) AS n_words, len(w.words) - coalesce(k.n, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM worded w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

OP10_SQL = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("text"))} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) = 0 THEN []
         WHEN len(words) = 1 THEN words
         ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])
    END) AS shingle
  FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
either_way AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT r.node, l.b FROM reached r JOIN either_way l ON r.other = l.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.other) AS component_id,
       d.doc_id = min(r.other) AS kept
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id JOIN reached r ON d.doc_id = r.node
GROUP BY d.doc_id, s.n
"""

OP12_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS nth
        FROM scores WHERE same) WHERE nth <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                            ORDER BY s.score DESC, s.other_id) AS nth
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE nth <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_line_dedup": OP5_SQL,
        "op9_substring_dedup": OP9_SQL,
        "op10_minhash_near_dedup": OP10_SQL,
        "op12_hard_negatives": OP12_SQL,
    }
