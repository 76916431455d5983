"""One query per operator, applied to its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm import centroids, exact_dedup, imatch, language, line_quality, merkle, near_dedup, packing, quotes, sharding
from kerbline.llm import sql, token_files, url_rules, wfst
from kerbline.llm.common import table
from kerbline.llm.tokens import tokenizer
from kerbline.session import shared_dir

#: The rules that the URL query judges by.
SITE_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


#: Stretches that a worker remembers where ids are all that it makes: some 120 MB.
MANY_STRETCHES = 600_000


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    rules = [url_rules.site_rule(*rule) for rule in SITE_RULES]
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles are similar at 0.85 or more."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 tokens."""
    ids = tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.digests(packing.pack(table(spark, sf_dir, "documents"), ids, capacity=2048, end_id=1))


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of all documents and of their edited texts."""
    found = imatch.fingerprint_with_edits(table(spark, sf_dir, "documents"))
    return found.withColumn("edited", F.sha2("edited", 256)).withColumnRenamed("edited", "edited_sha256")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of texts that are equal but for white space, and the row of each that stays."""
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op6_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotes."""
    return quotes.reply_ordered(table(spark, sf_dir, "conversations"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to files of coded blocks and read back."""
    ids = tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"), remembered=MANY_STRETCHES)
    path = shared_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), ids, path, end_id=0)
    found = token_files.read(spark.read.parquet(path))
    count = (F.octet_length("ids") / 4).cast("long")
    return found.select("doc_id", "start", count.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    return sharding.shard(table(spark, sf_dir, "documents"), shards=8)


def op9_wfst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of all documents, and the texts that they decode to."""
    model = wfst.piece_model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    found = wfst.decode_ids(wfst.encode_texts(table(spark, sf_dir, "documents"), model), model)
    count = (F.octet_length("ids") / 4).cast("long")
    decoded = F.sha2("text", 256).alias("decoded_sha256")
    return found.select("doc_id", count.alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), decoded)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a network that learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    network = language.fit(docs.select("doc_id", "text", "lang"))
    known = docs.select("doc_id", "text", (language.fold() == 2).alias("held_out"))
    return language.predict(spark, known, network).select("doc_id", "held_out", "lang_pred", "score")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents in a manifest with a tree a language, and which of them hold after some were tampered with."""
    docs = table(spark, sf_dir, "documents")
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, 1).otherwise(0)
    claimed = F.col("n_chars").cast("decimal(20,0)") + claimed

    def leaf(n_chars: Column) -> Column:
        return merkle.digest(*map(merkle.field, (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))))

    rows = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), leaf(F.coalesce(claimed, "n_chars")).alias("claimed"))
    found = merkle.proofs(rows, leaf="leaf", group="lang", order="doc_id", fanout=2)
    found = found.withColumn("folded_root", merkle.folded(F.col("claimed"), F.col("steps")))
    proof = F.sha2(merkle.siblings(F.col("steps")), 256).alias("proof_sha256")
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", verified)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in eight clusters after ten rounds."""
    return centroids.clustered(table(spark, sf_dir, "embeddings"), clusters=8, rounds=10, size=64, seed=3)


def op13_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents, and what is left of their texts without the lines that break a rule."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("cleaned"))
    return line_quality.judged(docs, text="cleaned").select(
        "doc_id",
        *line_quality.COUNTS,
        "base_failed",
        "kept",
        *(f"{rule}_lines" for rule in line_quality.RULES),
        "lost_words",
        F.sha2("cleaned", 256).alias("cleaned_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_near_dedup": op2_near_dedup,
    "op3_packing": op3_packing,
    "op4_imatch": op4_imatch,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quotes": op6_quotes,
    "op7_token_files": op7_token_files,
    "op8_sharding": op8_sharding,
    "op9_wfst": op9_wfst,
    "op10_language": op10_language,
    "op11_merkle": op11_merkle,
    "op12_centroids": op12_centroids,
    "op13_line_quality": op13_line_quality,
}


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"


_BY_LENGTH = sorted(SITE_RULES, key=lambda rule: -len(rule[0] + rule[1]))
_RULE = " ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _BY_LENGTH)
_VERDICT = " ".join(f"WHEN {_fits(h, p)} THEN '{v}'" for h, p, v in _BY_LENGTH)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op1_url_filter": f"""
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        )
        SELECT page_id, host, path, CASE {_RULE} END AS rule, CASE {_VERDICT} ELSE 'allow' END AS verdict
        FROM parts""",
    "op2_near_dedup": """
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(
                string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[\\x20\\x09-\\x0D]+'),
                lambda w: w <> '') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s
            FROM split
        ), one AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
        ), links AS (
            SELECT a.doc_id AS u, b.doc_id AS v FROM one a JOIN one b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT doc_id AS node, doc_id AS root FROM documents
            UNION
            SELECT links.v, reach.root FROM reach JOIN links ON links.u = reach.node WHERE reach.root < links.v
        ), least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
        SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, sets.doc_id = component_id AS kept
        FROM sets JOIN least ON least.node = sets.doc_id""".replace("{upper}", _UPPER).replace("{lower}", _LOWER),
    "op5_exact_dedup": """
        WITH norm AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
            FROM documents
        ), ranked AS (
            SELECT doc_id, body, count(*) OVER (PARTITION BY body) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id
            FROM norm
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM ranked""",
    "op11_merkle": sql.MERKLE,
    "op12_centroids": sql.CENTROIDS,
    "op13_line_quality": sql.QUALITY,
}
