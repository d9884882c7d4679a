"""The operators applied to their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import chat, fim, forest, langid, mixing, multiprobe, pieces, secrets, simhash, token_files, topk, toxicity, whitening
from orderlens.llm.common import fold
from orderlens.session import pin, shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the installed public vocabulary ``name`` lies; any other path may be passed instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


WORD_BPE, PIECE_MODEL = "word_bpe_49k.json", "piece_bpe_32k.model"
END_ID = 1


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_files.write(token_files.encode(docs, tokenizer_file(WORD_BPE), END_ID), path)
    return token_files.digests(token_files.read(spark, path))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    model = langid.learn(docs, ~F.col("held_out"))
    return langid.predict(docs, model, keep=["doc_id", "held_out"])


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "conversations")
    # One conversation more, whose texts are control strings.
    forged = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = stored.select("conv_id", "turn", "role", "text").unionByName(forged)
    output = chat.render(chat.from_frame(turns)).withColumn("formatted", chat.formatted_text(F.col("segments")))
    back = output.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


# 32 characters of marks a turn; escaping adds one to each control string.
OP3_SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(i)
), sized AS (
    SELECT *, 12 + 10 + 11
              + length(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g'))
              + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')) AS chars
    FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op4_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH RECURSIVE parts AS (
    SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM parts a JOIN parts b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
    SELECT vec_id AS origin, vec_id AS node FROM embeddings
    UNION
    SELECT r.origin, l.b FROM reach r JOIN links l ON l.a = r.node
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links,
       m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN (SELECT origin, min(node) AS component_id FROM reach GROUP BY origin) m ON m.origin = e.vec_id
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0, store=pin)
    return toxicity.score(docs, model, keep=["doc_id", "held_out"])


def op6_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


OP6_SQL = """
WITH whole AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = [r.kind for r in secrets.BASE_RULES]
    basic = F.filter("secrets", lambda s: s["kind"].isin(base))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, base), F.sha2(secrets.listed(basic).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids per document; ``round_trip`` says that decoding them gave the stored text back, byte for byte."""
    docs = table(spark, sf_dir, "documents").withColumn("stored_crc32", F.crc32(F.col("text").cast("binary")))
    coded = pieces.encode(docs, tokenizer_file(PIECE_MODEL), keep=["doc_id", "stored_crc32"], decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", "decoded_chars",
        F.col("decoded_crc32").eqNullSafe(F.col("stored_crc32")).alias("round_trip"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def dealt(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The plan of every document, and the copies it takes, stored in training order."""
    sizes = pin(mixing.measured(table(spark, sf_dir, "documents")), "mix-sizes")
    planned = pin(mixing.plan(sizes), "mix-plan")
    steps = planned.select("doc_id", "source", F.struct(*mixing.STEP).alias("step"))
    order = mixing.in_training_order(mixing.copies(steps, "step"))
    return planned, pin(order.select("doc_id", "source", "step.middle", "copy", "position"), "mix-order")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document gives to the training order, counted from its copies there."""
    planned, order = dealt(spark, sf_dir)
    # Middles differ within a source: a row without words lies at the edge of others and takes no copy.
    counted = order.groupBy(F.col("source").alias("line"), F.col("middle").alias("at")).agg(F.count("position").alias("n"))
    both = planned.join(
        counted, planned["source"].eqNullSafe(F.col("line")) & (planned["middle"] == F.col("at")) & (planned["size"] > 0),
        "left")
    taken = F.coalesce(F.col("n"), F.lit(0)) * F.col("size")
    return both.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy that is trained on, range-sorted by its position in the training."""
    _, order = dealt(spark, sf_dir)
    return mixing.in_training_order(order.select("doc_id", "copy", "position", "source"))


OP10_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS digest,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, 2.0 * sum(size)::DOUBLE AS cap,
           [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM sources
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, least(cap, weight * (
        SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1
    )) AS target
    FROM levels
), placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, s.size / 2.0::DOUBLE + coalesce(
        sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest, s.doc_id NULLS FIRST, s.size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS middle
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size > 0 AND middle < target THEN ceil((target - middle) / source_size) ELSE 0 END
        * size)::BIGINT AS taken
FROM placed
"""


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"), keep=["doc_id"])

    def digest(text):
        return F.sha2(text.cast("binary"), 256)

    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP11_SQL = r"""
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
           sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n, ('0x' || digest[1:8])::UBIGINT % (len(units) + 1) AS one,
           ('0x' || digest[9:16])::UBIGINT % (len(units) + 1) AS two,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                WHEN ('0x' || digest[25:32])::UBIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM lines
), parts AS (
    SELECT *, array_to_string(units[1:least(one, two)], '') AS prefix,
           array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
           array_to_string(units[greatest(one, two) + 1:n], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def op12_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiprobe.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = rows.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "one"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("one.whitened").alias("whitened"), F.col("one.explained").alias("explained"), "identity_error")


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_language_id": op2_language_id,
    "op3_chat": op3_chat,
    "op4_embedding_forest": op4_embedding_forest,
    "op5_toxicity": op5_toxicity,
    "op6_pivot_top_k": op6_pivot_top_k,
    "op7_secrets": op7_secrets,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_simhash": op9_simhash,
    "op10_mixing": op10_mixing,
    "op10_training_order": op10_training_order,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_multiprobe": op12_multiprobe,
    "op13_whitening": op13_whitening,
}

SQL = {
    "op3_chat": OP3_SQL,
    "op4_embedding_forest": OP4_SQL,
    "op6_pivot_top_k": OP6_SQL,
    "op10_mixing": OP10_SQL,
    "op11_fill_in_middle": OP11_SQL,
}
