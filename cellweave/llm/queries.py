"""Queries opN_<name> over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""


def op5_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .reply_trees import chain_nodes, format_paths, formatted_digests
    from .shared import written

    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    nodes = written(chain_nodes(rows.unionByName(own)), "nodes")
    return formatted_digests(written(format_paths(nodes), "formatted"))


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), t AS (
  SELECT *, length(regexp_replace(role, '([<\[\\])', '\1\\', 'g')) + length(regexp_replace(text, '([<\[\\])', '\1\\', 'g'))
            + 9 + CASE WHEN role = 'assistant' THEN 4 ELSE 7 END AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sizes

    return mix_sizes(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import scan_documents

    return scan_documents(table(spark, sf_dir, "documents"))


def op3_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_files import read_token_files, write_token_files

    manifest = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(manifest)


def op1_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .piece_viterbi import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import fit, predict_documents

    docs = table(spark, sf_dir, "documents")
    return predict_documents(docs, fit(docs))


def op4_min_max_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_groups

    return near_groups(table(spark, sf_dir, "documents"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .multi_index import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import drop_repeats

    return drop_repeats(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op5_reply_trees": OP5_SQL, "op6_exact_dedup": OP6_SQL}
