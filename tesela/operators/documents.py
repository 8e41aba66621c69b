"""Documents, chunks and question contexts (RAG-01 ... RAG-09) as batch jobs.

The source serves one question at a time from a web handler. Here a batch
of questions is a DataFrame and every step is a join, a window or an
aggregate:

- mention detection looks the vocabulary up in an inverted index of the
  questions' n-grams;
- retrieval matches the distinct departments of the table against the
  mentioned names the same way, then reaches the rows with an
  equi-join on the department, followed by ``row_number() <= 50`` per
  question, which Spark plans as a window group limit: each task keeps its
  own first 50 rows per question before the shuffle, so a department
  holding a third of the table never lands in one task;
- the fallback rows are one distributed top-50 (``TakeOrderedAndProject``)
  folded into one broadcast row for the questions that found nothing;
- similarity search scores the corpus against counted, bounded batches of
  query vectors travelling as one broadcast row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..session import ensure_checkpoint_dir
from .indexing import dense_index, stored_index
from .substrings import names_in_texts

SEP = " | "
MAX_BROADCAST_QUESTIONS = 5000
# (question, department) pairs broadcast to the table scan at most; above
# this the retrieval join shuffles both sides instead.
MAX_BROADCAST_PAIRS = 200_000


# ------------------------------------------------------------------ RAG-01
def row_text(columns: Sequence[str], alias_prefix: str = "") -> Column:
    """``k: v | k: v`` over the non-null cells, in column order."""
    parts = [F.when(F.col(f"{alias_prefix}{c}").isNotNull(),
                    F.concat(F.lit(f"{c}: "), F.col(f"{alias_prefix}{c}").cast("string"))) for c in columns]
    return F.concat_ws(SEP, *parts)


def to_documents(df: DataFrame, source_name: str, order: Sequence[str] | None = None, stored: bool = False) -> DataFrame:
    """RAG-01: one document per row, ``id = <source>_<i>``.

    ``i`` is the row's position in ``order`` (default: all columns), made
    dense without a single-partition window (``indexing.dense_index``). A
    table read from files that are in that order already (``stored``) is
    numbered from the files' sizes, without a sort. Nulls are skipped (the source prints pandas NaN as ``nan``; here a
    missing cell is simply absent).
    """
    cols = list(df.columns)
    keys = list(order or cols)
    indexed = stored_index(df, "_i") if stored else dense_index(df, [F.col(c).asc_nulls_first() for c in keys], "_i")
    return indexed.select(
        F.concat(F.lit(f"{source_name}_"), F.col("_i").cast("string")).alias("id"),
        row_text(cols).alias("content"),
        F.struct(F.lit(source_name).alias("source"), F.col("_i").alias("index")).alias("metadata"),
    )


# ------------------------------------------------------------------ RAG-02
def _chunk_expr(content: str, chunk_size: int, chunk_overlap: int) -> Column:
    """Greedy chunking of `` | ``-separated pieces as one native fold.

    State: finished chunks, the current pieces and their total length.
    Before a piece would push the size over ``chunk_size`` (and the current
    chunk is not empty) the chunk is closed and restarted with its longest
    suffix whose lengths sum to at most ``chunk_overlap``. Separators do not
    count towards sizes; an oversize piece stays whole.
    """
    size, over = int(chunk_size), int(chunk_overlap)
    suffix_count = (
        "aggregate(reverse(acc.cur), named_struct('tot', 0, 'k', 0, 'stop', false), "
        f"(a, x) -> IF(a.stop OR a.tot + length(x) > {over}, named_struct('tot', a.tot, 'k', a.k, 'stop', true), "
        "named_struct('tot', a.tot + length(x), 'k', a.k + 1, 'stop', false)))"
    )
    step = (
        "(acc, s) -> IF(acc.size + length(s) > {size} AND size(acc.cur) > 0, "
        "named_struct('done', array_append(acc.done, array_join(acc.cur, ' | ')), "
        "'cur', array_append(slice(acc.cur, size(acc.cur) - {sc}.k + 1, {sc}.k), s), "
        "'size', {sc}.tot + length(s)), "
        "named_struct('done', acc.done, 'cur', array_append(acc.cur, s), 'size', acc.size + length(s)))"
    ).format(size=size, sc=suffix_count)
    finish = "acc -> IF(size(acc.cur) > 0, array_append(acc.done, array_join(acc.cur, ' | ')), acc.done)"
    init = "named_struct('done', CAST(array() AS ARRAY<STRING>), 'cur', CAST(array() AS ARRAY<STRING>), 'size', 0)"
    pieces = f"split(coalesce({content}, ''), ' \\\\| ', -1)"
    return F.expr(f"aggregate({pieces}, {init}, {step}, {finish})")


def split_documents(docs: DataFrame, chunk_size: int = 1000, chunk_overlap: int = 100,
                    content: str = "content", keep: Sequence[str] = ("id", "metadata")) -> DataFrame:
    """RAG-02: one row per chunk ``(..keep, chunk_no, content)``."""
    chunks = _chunk_expr(content, chunk_size, chunk_overlap)
    kept = [c for c in keep if c in docs.columns]
    return docs.select(*kept, F.posexplode(chunks).alias("chunk_no", "chunk"))\
        .withColumnRenamed("chunk", "content")


def sentences_as_pieces(text: Column) -> Column:
    """Documents text with sentence ends turned into the `` | `` separator."""
    return F.regexp_replace(text, r"(?<=[.!?])\s+", SEP)


# ------------------------------------------------------------------ RAG-03
def detect_mentions(questions: DataFrame, vocabulary: DataFrame, question: str = "question",
                    name: str = "name") -> DataFrame:
    """RAG-03: ``(qid, name)`` for every vocabulary word that occurs in the
    lower-cased question (substring match, so ``cauca`` also fires inside
    ``valle del cauca``), found through an index of the questions' n-grams."""
    texts = questions.select("qid", F.lower(F.col(question)).alias("_question"))
    return names_in_texts(texts, vocabulary.select(F.col(name).alias("name")), "qid", "_question", "name")


def default_vocabulary(spark) -> DataFrame:
    return spark.createDataFrame([(n,) for n in vocab.QUESTION_DEPARTMENTS], "name string")


# ------------------------------------------------------------------ RAG-04
def _batches(df: DataFrame, key: str, max_rows: int) -> list[DataFrame]:
    """Split ``df`` into hash batches of at most about ``max_rows`` rows, so
    each batch can be broadcast with a known bound."""
    n = df.count()
    if n <= max_rows:
        return [df]
    k = -(-n // max_rows)
    return [df.filter(F.pmod(F.xxhash64(key), F.lit(k)) == i) for i in range(k)]


def _as_one_row(df: DataFrame, alias: str) -> DataFrame:
    """A bounded DataFrame folded into one row holding an array of structs;
    joined to a big table it is a one-row broadcast, not a pairwise join."""
    return df.agg(F.collect_list(F.struct(*df.columns)).alias(alias))


def retrieve(table: DataFrame, questions: DataFrame, mentions: DataFrame, order: Sequence[str],
             limit: int = 50, dept_col: str = "departamento",
             max_broadcast_pairs: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """RAG-04: per question, the first ``limit`` rows (in ``order``) whose
    department contains any mentioned name (``ILIKE '%name%'``); questions
    without mentions or without hits get the first ``limit`` rows of the
    whole table. Output ``(qid, rn, <table columns>)``.

    The (question, department) pairs are materialised and counted; within
    ``max_broadcast_pairs`` they are broadcast (above the bound they are
    shuffled instead). The table is ranked once per wanted department, not
    once per question: only ``limit`` rows per department reach the join
    with the pairs, however many questions name it.
    """
    cols = table.columns
    sort = [F.col(c).asc_nulls_first() for c in order]
    # The substring test only depends on the department value: match the
    # distinct departments against the mentioned names by n-grams, then
    # reach the rows with an equi-join on the department.
    depts = table.select(F.col(dept_col).alias("_dep")).distinct()
    dep_names = names_in_texts(depts.withColumn("_low", F.lower("_dep")), mentions.select(F.col("name").alias("_name")), "_dep", "_low", "_name")
    q_dep = (mentions.join(dep_names, mentions.name == dep_names._name)
             .select("qid", F.col("_dep")).distinct())
    # small and used twice: materialise once (lineage cut in the checkpoint
    # folder), then size-check before broadcasting
    ensure_checkpoint_dir(table.sparkSession)
    q_dep = q_dep.checkpoint(eager=True)
    small = q_dep.count() <= max_broadcast_pairs
    pairs = F.broadcast(q_dep) if small else q_dep
    wanted = q_dep.select("_dep").distinct()
    wanted = F.broadcast(wanted) if small else wanted
    # A question's hits are the disjoint union of its departments' rows, so
    # its first ``limit`` rows are among the first ``limit`` of each of its
    # departments: rank per department once (a window group limit keeps a
    # partial top-``limit`` per map task, so a hot department never reaches
    # one task whole), then fan the few survivors out to the questions.
    per_dep = (table.join(wanted, table[dept_col] == wanted._dep, "left_semi")
               .withColumn("_rd", F.row_number().over(Window.partitionBy(dept_col).orderBy(*sort)))
               .filter(F.col("_rd") <= limit).drop("_rd"))
    w = Window.partitionBy("qid").orderBy(*sort)
    hits = (per_dep.join(pairs, per_dep[dept_col] == pairs._dep).select("qid", *cols)
            .withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= limit))
    first = (table.orderBy(*sort).limit(limit)
             .withColumn("rn", F.row_number().over(Window.orderBy(*sort))))
    # every (question, department) pair comes from a department present in
    # the table, so it has at least one hit: no second pass over the hits
    answered = q_dep.select("qid").distinct()
    fallback_q = questions.select("qid").join(answered, "qid", "left_anti")
    rows = F.broadcast(_as_one_row(first, "_rows"))
    fallback = (fallback_q.crossJoin(rows).select("qid", F.inline("_rows")))
    return hits.select("qid", *cols, "rn").unionByName(fallback.select("qid", *cols, "rn"))


# ------------------------------------------------------------------ RAG-05 / RAG-06
def contexts(questions: DataFrame, retrieved: DataFrame, columns: Sequence[str], rows: int = 30) -> DataFrame:
    """RAG-05: first ``rows`` retrieved rows per question as ``k: v`` lines
    joined by newlines; ``No hay datos disponibles.`` when there are none.
    Each group is bounded by ``rows``."""
    lines = (retrieved.filter(F.col("rn") <= rows)
             .select("qid", "rn", row_text(columns).alias("_line"))
             .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rn", "_line"))).alias("_l")))
    ctx = lines.select("qid", F.array_join(F.transform("_l", lambda s: s["_line"]), "\n").alias("context"))
    return (questions.join(ctx, "qid", "left")
            .select("qid", "question", F.coalesce("context", F.lit(vocab.NO_DATA_CONTEXT)).alias("context")))


def build_prompts(ctx: DataFrame) -> DataFrame:
    """RAG-06: the fixed prompt with the context and the question filled in."""
    head, rest = vocab.PROMPT_TEMPLATE.split("{context}")
    mid, tail = rest.split("{question}")
    return ctx.select("qid", F.concat(F.lit(head), F.col("context"), F.lit(mid), F.col("question"),
                                      F.lit(tail)).alias("prompt"))


# ------------------------------------------------------------------ RAG-07
def centroids(emb: DataFrame, key: str = "label", vec: str = "embedding") -> DataFrame:
    """Mean vector per ``key`` (a bounded-dimension array per group)."""
    ex = emb.select(key, F.posexplode(vec).alias("_pos", "_v"))
    per = ex.groupBy(key, "_pos").agg(F.avg(F.col("_v").cast("double")).alias("_m"))
    return (per.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_m"))).alias("_s"))
            .select(key, F.transform("_s", lambda s: s["_m"]).alias("query_vec")))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def similarity_search(corpus: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
                      vec: str = "embedding", qid: str = "qid", qvec: str = "query_vec",
                      max_broadcast_queries: int = MAX_BROADCAST_QUESTIONS) -> DataFrame:
    """RAG-07: top-``k`` corpus rows by cosine similarity per query.

    A batch of queries (bounded, counted first) travels as one broadcast
    row; every corpus row scores itself against the batch, the corpus never
    moves, and the per-query top-k is a window group limit (map-side
    partial top-k before the shuffle). Norms are taken once per vector.
    ``vector_index`` is the form for large corpora and query sets.
    """
    c = corpus.select(id_col, F.col(vec).cast("array<double>").alias("_e"))
    c = c.withColumn("_n", F.sqrt(_dot(F.col("_e"), F.col("_e"))))
    qs = queries.select(F.col(qid).alias("qid"), F.col(qvec).cast("array<double>").alias("q"))
    qs = qs.withColumn("qn", F.sqrt(_dot(F.col("q"), F.col("q"))))
    out = None
    for batch in _batches(qs, "qid", max_broadcast_queries):
        one = F.broadcast(_as_one_row(batch, "_qs"))
        scores = F.transform("_qs", lambda q: F.struct(q["qid"].alias("qid"), F.try_divide(_dot(q["q"], F.col("_e")), q["qn"] * F.col("_n")).alias("score")))
        scored = c.crossJoin(one).select(id_col, F.inline(scores))
        w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col(id_col).asc())
        top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        out = top if out is None else out.unionByName(top)
    return out.withColumnRenamed("qid", qid) if qid != "qid" else out


# ------------------------------------------------------------------ RAG-09
def corpus_status(docs: DataFrame, source: str = "source") -> DataFrame:
    """RAG-09: documents per source (categories), one aggregate."""
    return docs.groupBy(F.col(source).alias("categoria")).agg(F.count(F.lit(1)).alias("num_documentos"))
