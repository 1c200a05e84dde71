"""The registered queries of the operators and, where SQL can express one, the expected result for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import jaccard, lattice, line_dedup, lm, merkle, negatives, sanitise, secrets, spans, topk, toxicity, transducer, trie, winnowing
from evenkeel.llm.tables import given, id_remainder, written


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    documents = given(spark, folder, "documents")
    model = lm.train(documents.where(id_remainder(F.col("doc_id")) != 1))
    return lm.score(documents, model).select(
        "doc_id", (id_remainder(F.col("doc_id")) == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(given(spark, folder, "documents"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.secrets(given(spark, folder, "documents"))
    base, every = ["assign", "access", "hex"], ["assign", "access", "hex", "entropy"]
    found = found.withColumn("base", F.array_sort(spans.labelled(base))).withColumn("every", F.array_sort(spans.labelled(every)))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in every],
        F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"), spans.joined(F.col("every")).alias("spans"),
    )


def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.integer_vectors(given(spark, folder, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = given(spark, folder, "documents"), given(spark, folder, "labels")
    model = toxicity.train(documents, labels.where(id_remainder(F.col("doc_id")) != 0))
    found = toxicity.score(documents, model)
    return found.select("doc_id", (id_remainder(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    found = lattice.encode(given(spark, folder, "documents"), tokenizer_path(), keep_ids=False)
    return found.select(
        "doc_id", "n_pieces", "score", "ids_sha256", "restored", F.transform("n_best", lambda b: b["score"]).alias("best_scores")
    )


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.removed_lines(given(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return transducer.token_counts(given(spark, folder, "documents"), tokenizer_path())


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = sanitise.personal_data(given(spark, folder, "documents"))
    base = F.array_sort(F.transform("entities", lambda e: F.struct(e["kind"].alias("kind"), e["start"].alias("start"), e["end"].alias("end"))))
    found = found.select("doc_id", base.alias("base"), "terms")
    names = F.array(*[F.lit(k) for k in sanitise.KINDS])
    said = F.transform("base", lambda e: F.concat_ws(":", F.element_at(names, e["kind"] + 1), e["start"].cast("string"), e["end"].cast("string")))
    terms = F.transform("terms", lambda t: F.concat_ws(":", F.lit("term"), t["start"].cast("string"), t["end"].cast("string")))
    return found.select(
        "doc_id", *[F.size(F.filter("base", lambda e: e["kind"] == F.lit(k))).cast("long").alias(f"n_{n}") for k, n in enumerate(sanitise.KINDS)],
        F.size("terms").cast("long").alias("n_term"), F.sha2(F.array_join(said, ","), 256).alias("base_sha256"), F.array_join(F.concat(said, terms), ",").alias("spans"),
    )


def op10_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    found = winnowing.contamination(given(spark, folder, "documents"), given(spark, folder, "benchmark"))
    return found.drop("hit_spans")


def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = merkle.with_edit(given(spark, folder, "documents"))
    for text, tree in (("text", "own"), ("edited", "later"), ("next_text", "next")):
        rows = merkle.with_tree(rows, text, tree)
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.col("own.root").alias("fingerprint"), F.col("later.root").alias("edited_fingerprint"),
        merkle.likeness(F.col("own"), F.col("later")).alias("near_edited"),
        merkle.likeness(F.col("own"), F.col("next")).alias("near_next"),
        F.size("own.sections").cast("long").alias("n_sections"), F.size("own.paragraphs").cast("long").alias("n_paragraphs"),
        F.size(F.array_except("later.paragraphs", "own.paragraphs")).cast("long").alias("n_added"),
    )


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    vectors = trie.integer_parts(given(spark, folder, "embeddings"), "vec_id", "embedding", 4096)
    books = trie.train(vectors, parts=8, entries=16, rounds=6)
    coded = trie.with_label_error(written(trie.encode(vectors, books), "codes"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = negatives.labelled_vectors(given(spark, folder, "embeddings"), "vec_id", label, "embedding", 256)
    return negatives.hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_secrets": op3_secrets,
    "op4_topk": op4_topk,
    "op5_pieces": op5_pieces,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_personal_data": op9_personal_data,
    "op10_winnowing": op10_winnowing,
    "op11_fingerprints": op11_fingerprints,
    "op12_vector_codes": op12_vector_codes,
    "op13_hard_negatives": op13_hard_negatives,
}


def _code_rounds_sql(rounds: int) -> str:
    """Rounds of assigning parts ``p`` to codebooks ``b0`` and averaging; the last codebook is ``b<rounds>``."""
    steps = ""
    for k in range(1, rounds + 1):
        steps += f"""
             a{k} AS MATERIALIZED (SELECT p, x, n, min(d * 16 + e) % 16 AS e FROM
                      (SELECT p.p, p.x, p.n, b.e, list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p JOIN b{k - 1} b ON p.p = b.p) GROUP BY p, x, n),
             m{k} AS (SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS c FROM
                      (SELECT p, e, i, sum(n * x[i])::BIGINT AS s, sum(n)::BIGINT AS c FROM a{k}, unnest(range(1, len(x) + 1)) t(i) GROUP BY p, e, i) GROUP BY p, e),
             b{k} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{k - 1} b LEFT JOIN m{k} m ON b.p = m.p AND b.e = m.e),"""
    return steps


def _tree_sql(text: str, name: str) -> str:
    """The nodes of a text's tree as columns of DuckDB, each level under its own name."""
    ends = "CASE WHEN left(x, 1) IN ('0', '8') OR x = sha256('') THEN chr(10) ELSE ' ' END"
    return f"""
        {name}_p AS (SELECT *, list_transform(string_split({text}, chr(10)), lambda x: sha256(x)) AS {name}_para,
                       string_split(regexp_replace({text}, '([^{merkle.PLAIN}])\\x20', '\\1 ' || chr(10), 'g'), chr(10)) AS {name}_leaf FROM %s),
        {name}_s AS (SELECT *, list_transform(string_split(rtrim(array_to_string(list_transform({name}_para, lambda x: x || {ends}), ''), chr(10)), chr(10)), lambda x: sha256(x)) AS {name}_sec FROM {name}_p),
        {name}_r AS (SELECT *, sha256(array_to_string({name}_sec, ' ')) AS {name}_root FROM {name}_s),
        {name}_t AS (SELECT *, list_distinct(list_concat(['r' || {name}_root], list_transform({name}_sec, lambda x: 's' || x),
                       list_transform({name}_para, lambda x: 'p' || x), list_transform({name}_leaf, lambda x: 'l' || x))) AS {name}_all FROM {name}_r)"""


ORACLES: dict[str, str] = {
    "op4_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS c FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.c, d.c)::BIGINT AS score
                   FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op7_line_dedup": """
        WITH l AS (SELECT doc_id, unnest(range(0, len(x)))::INTEGER AS line, unnest(x) AS t FROM
                     (SELECT doc_id, string_split(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)) AS x FROM documents)),
             w AS (SELECT doc_id, line, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM l),
             s AS (SELECT DISTINCT doc_id, line, unnest(list_transform(range(0, greatest(len(w) - 4, 1)), lambda i: w[i + 1 : i + 5])) AS s FROM w WHERE len(w) > 0),
             n AS (SELECT doc_id, line, count(*) AS n FROM s GROUP BY ALL),
             o AS (SELECT a.doc_id, a.line, b.doc_id AS other, b.line AS other_line, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND (b.doc_id, b.line) < (a.doc_id, a.line) GROUP BY ALL),
             g AS (SELECT DISTINCT o.doc_id, o.line FROM o JOIN n x ON (x.doc_id, x.line) = (o.doc_id, o.line) JOIN n y ON (y.doc_id, y.line) = (o.other, o.other_line)
                   WHERE 100 * k >= 75 * (x.n + y.n - k)),
             r AS (SELECT doc_id, count(*) AS n, string_agg(line::VARCHAR, ',' ORDER BY line) AS lines FROM g GROUP BY doc_id)
        SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0) AS n_lines, coalesce(n, 0) AS n_removed, coalesce(lines, '') AS removed
        FROM documents LEFT JOIN r USING (doc_id)""",
    "op10_winnowing": """
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
             b AS (SELECT item_id, list_filter(regexp_split_to_array(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
             bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(0, len(w) - least(len(w), 10) + 1), lambda i: w[i + 1 : i + least(len(w), 10)])) AS win FROM b WHERE len(w) > 0),
             n AS (SELECT DISTINCT n FROM bw),
             dw AS (SELECT doc_id, n, unnest(range(0, len(w) - n + 1)) AS s, unnest(list_transform(range(0, len(w) - n + 1), lambda i: w[i + 1 : i + n])) AS win FROM d, n WHERE len(w) >= n),
             m AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
             h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
             i AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op11_fingerprints": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             n AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id DESC NULLS LAST), first_value(t) OVER (ORDER BY doc_id DESC NULLS LAST)) AS x FROM d),
             e AS (SELECT *, substring(t, 1, (length(t) - length(t) // 3)::INT) || substring(x, 1, (length(t) // 3)::INT) AS e FROM n),
             {_tree_sql("t", "a") % "e"}, {_tree_sql("e", "b") % "a_t"}, {_tree_sql("x", "c") % "b_t"}
        SELECT doc_id, length(t) AS n_chars, sha256(e) AS edited_sha256, a_root AS fingerprint, b_root AS edited_fingerprint,
               2.0::DOUBLE * len(list_intersect(a_all, b_all)) / (len(a_all) + len(b_all)) AS near_edited,
               2.0::DOUBLE * len(list_intersect(a_all, c_all)) / (len(a_all) + len(c_all)) AS near_next,
               len(a_sec) AS n_sections, len(a_para) AS n_paragraphs,
               len(list_distinct(list_filter(b_para, lambda x: NOT list_contains(a_para, x)))) AS n_added
        FROM c_t""",
    "op12_vector_codes": f"""
        WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             q AS (SELECT r, vec_id, t.p, v[t.p * (len(v) // 8) + 1 : (t.p + 1) * (len(v) // 8)] AS x FROM v, range(8) t(p)),
             p AS MATERIALIZED (SELECT p, x, count(*) AS n FROM q GROUP BY p, x),
             b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM q QUALIFY e < 16),{_code_rounds_sql(6)}
             z AS MATERIALIZED (SELECT p, x, min(d * 16 + e) % 16 AS e, min(d) AS d FROM
                      (SELECT p.p, p.x, b.e, list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p JOIN b6 b ON p.p = b.p) GROUP BY p, x),
             c AS (SELECT v.vec_id, v.label, string_agg(printf('%02x', z.e), '' ORDER BY z.p) AS code, sum(z.d)::BIGINT AS error
                   FROM v JOIN q ON v.r = q.r JOIN z ON q.p = z.p AND q.x = z.x GROUP BY v.r, v.vec_id, v.label),
             h AS (SELECT sha256(string_agg(c[i]::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b6, unnest(range(1, len(c) + 1)) t(i))
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT codebooks_sha256 FROM h) AS codebooks_sha256 FROM c""",
    "op13_hard_negatives": """
        WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, list_dot_product(a.c, d.c)::BIGINT AS score FROM v a JOIN v d ON a.vec_id <> d.vec_id WHERE a.vec_id % 100 = 0),
             p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
               s.vec_id AS negative_id, positive_score, s.score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score QUALIFY rank <= 5""",
}
