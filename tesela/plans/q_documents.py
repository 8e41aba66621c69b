"""Registered document, chunk and question-context jobs (RAG-01 ... RAG-09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import analysis, documents as D, filters, vector_index
from ..sources import questions as Q
from ..sources.tables import read_table
from . import q_measures, registry, warehouse  # noqa: F401  (the insight oracle reuses measure SQL)
from .q_contracts import master
from .registry import register
from .sqlclean import q
from .sqlkit import on_master

MASTER_ORDER = [
    "id_contrato", "referencia", "nombre_entidad", "nit_entidad", "departamento", "ciudad", "proceso_de_compra",
    "tipo_contrato", "modalidad", "estado_contrato", "fecha_firma", "fecha_inicio", "valor_contrato",
    "valor_pagado", "proveedor", "sector", "objeto_contrato", "numero_proponentes", "origen",
]
_ORDER_SQL = ", ".join(f"{c} nulls first" for c in MASTER_ORDER)
_ORDER_T_SQL = ", ".join(f"t.{c} nulls first" for c in MASTER_ORDER)


def _row_text_sql(prefix: str = "") -> str:
    parts = ", ".join(f"case when {prefix}{c} is not null then '{c}: ' || cast({prefix}{c} as varchar) end"
                      for c in MASTER_ORDER)
    return f"concat_ws(' | ', {parts})"


# ------------------------------------------------------------------ RAG-01
@register("rag_01_documentos", on_master(f"""
select 'contratacion_' || cast(row_number() over (order by {_ORDER_SQL}) - 1 as varchar) as id,
  {_row_text_sql()} as content, 'contratacion' as fuente,
  row_number() over (order by {_ORDER_SQL}) - 1 as indice
from master"""))
def q_rag_01(spark, d):
    layer = warehouse.materialize(spark, d, "master_in_order", master, sort_within=MASTER_ORDER)
    docs = D.to_documents(layer, "contratacion", MASTER_ORDER, stored=True)
    return docs.select("id", "content", F.col("metadata.source").alias("fuente"),
                       F.col("metadata.index").alias("indice"))


# ------------------------------------------------------------------ RAG-02
#: Chunk ``s..e`` of pieces with running lengths ``c``: it ends with the last
#: piece that keeps it within 1000, and holds the piece that closed the chunk
#: before it; the next one starts with the suffix of at most 100.
_CHUNKS_SQL = r"""
with recursive p as (select row_number() over () as rid, doc_id as id,
    string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t\n\x0B\f\r]+', '\1 | ', 'g'), ' | ') as ps from documents),
u as (select rid, unnest(ps) as piece, generate_subscripts(ps, 1) as k from p),
t as (select rid, k, sum(length(piece)) over (partition by rid order by k) as upto from u),
c as (select rid, list(upto order by k) as c from t group by rid),
r as (
  select rid, c, 0 as chunk_no, 1::bigint as s, greatest(1, len([x for x in c if x <= 1000])) as e from c
  union all
  select rid, c, chunk_no + 1, s2, greatest(e + 1, len([x for x in c if x <= before + 1000]))
  from (select *, case when s2 > 1 then c[s2 - 1] else 0 end as before
    from (select *, greatest(s, case when c[e] <= 100 then 1 else 2 + len([x for x in c if x < c[e] - 100]) end) as s2
      from r where e < len(c))))
select p.id, cast(chunk_no as integer) as chunk_no, array_to_string(ps[s:e], ' | ') as content from r join p using (rid)"""


@register("rag_02_fragmentos", _CHUNKS_SQL)
def q_rag_02(spark, d):
    docs = read_table(spark, d, "documents", "doc_id", "text").select(
        F.col("doc_id").alias("id"), D.sentences_as_pieces(F.col("text")).alias("content"))
    return D.split_documents(docs, 1000, 100, keep=("id",))


# ------------------------------------------------------------------ RAG-03
_QV = f"q as ({Q.QUESTIONS_SQL}),\nv as ({Q.VOCABULARY_SQL}),\nmen as (select qid, name from q join v on contains(lower(question), name))"


@register("rag_03_menciones", on_master(f", {_QV}\nselect qid, name from men"))
def q_rag_03(spark, d):
    return D.detect_mentions(Q.questions(spark, d), Q.vocabulary(spark, d))


def retrieved(spark, d):
    # the question batch and its mentions are small and used several times:
    # checkpoint them so the plan does not repeat their lineage
    qs = Q.questions(spark, d).checkpoint()
    men = D.detect_mentions(qs, Q.vocabulary(spark, d)).checkpoint()
    return qs, D.retrieve(master(spark, d), qs, men, MASTER_ORDER, 50)


_RETRIEVE_SQL = f""", {_QV},
wq as (select qid, list(name) as names from men group by qid),
hits as (select * from (select wq.qid, t.*, row_number() over (partition by wq.qid order by {_ORDER_T_SQL}) as rn
  from master t join wq on len(list_filter(wq.names, lambda n: contains(lower(t.departamento), n))) > 0) x
  where rn <= 50),
first50 as (select *, row_number() over (order by {_ORDER_SQL}) as rn from
  (select * from master order by {_ORDER_SQL} limit 50) f),
fb as (select q.qid, first50.* from q cross join first50 where q.qid not in (select distinct qid from hits)),
r as (select * from hits union all by name select * from fb)"""


@register("rag_04_recuperacion", on_master(f"{_RETRIEVE_SQL}\nselect * from r"), headline=True)
def q_rag_04(spark, d):
    return retrieved(spark, d)[1]


# ------------------------------------------------------------------ RAG-05 / RAG-06
_CTX_SQL = f"""{_RETRIEVE_SQL},
ctx as (select qid, string_agg({_row_text_sql()}, chr(10) order by rn) as context from r where rn <= 30 group by qid),
c2 as (select q.qid, q.question, coalesce(ctx.context, {q(vocab.NO_DATA_CONTEXT)}) as context
  from q left join ctx on q.qid = ctx.qid)"""


@register("rag_05_contexto", on_master(f"{_CTX_SQL}\nselect * from c2"))
def q_rag_05(spark, d):
    qs, r = retrieved(spark, d)
    return D.contexts(qs, r, MASTER_ORDER, 30)


_HEAD, _REST = vocab.PROMPT_TEMPLATE.split("{context}")
_MID, _TAIL = _REST.split("{question}")


@register("rag_06_prompt", on_master(
    f"{_CTX_SQL}\nselect qid, {q(_HEAD)} || context || {q(_MID)} || question || {q(_TAIL)} as prompt from c2"))
def q_rag_06(spark, d):
    qs, r = retrieved(spark, d)
    return D.build_prompts(D.contexts(qs, r, MASTER_ORDER, 30))


# ------------------------------------------------------------------ RAG-07
_SIM_SQL = """
with pos as (select label, unnest(generate_series(1, len(embedding))) as p, unnest(embedding) as v from embeddings),
c as (select label, list(m order by p) as qv from
  (select label, p, avg(cast(v as double)) as m from pos group by label, p) g group by label),
s as (select c.label as qid, e.vec_id,
  list_cosine_similarity(c.qv, cast(e.embedding as double[])) as score from c cross join embeddings e),
r as (select *, row_number() over (partition by qid order by score desc, vec_id) as rank from s)
select qid, vec_id, round(score, 4) as score, rank from r where rank <= 5"""


@register("rag_07_similitud", _SIM_SQL)
def q_rag_07(spark, d):
    emb = read_table(spark, d, "embeddings", "vec_id", "embedding", "label")
    qs = D.centroids(emb).select(F.col("label").alias("qid"), "query_vec")
    top = D.similarity_search(emb, qs, k=5)
    return top.select("qid", "vec_id", F.round("score", 4).alias("score"), "rank")


def _indexed(spark, d):
    """The index of all rows, and as queries every row whose id is divisible by 50."""
    emb = read_table(spark, d, "embeddings", "vec_id", "embedding")
    index = vector_index.build(emb, vector_index.fit(emb))
    return index, emb.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query_vec"))


@register("rag_07_indice", """
with s as (select a.vec_id as qid, b.vec_id, round(list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])), 12) as score
  from embeddings a cross join embeddings b where a.vec_id % 50 = 0),
r as (select *, row_number() over (partition by qid order by score desc, vec_id) as rank from s)
select qid, vec_id, round(score, 4) as score, rank from r where rank <= 10""")
def q_rag_07_index(spark, d):
    index, qs = _indexed(spark, d)
    top = vector_index.search(index, qs, k=10, exact=True)
    return top.select("qid", F.col("id").alias("vec_id"), F.round("score", 4).alias("score"), "rank")


@register("rag_07_indice_recall", """
select count(*) * 10 as buscados, true as recall_suficiente from embeddings where vec_id % 50 = 0""")
def q_rag_07_recall(spark, d):
    """Recall of the index probing its calibrated number of lists."""
    index, qs = _indexed(spark, d)
    truth = vector_index.search(index, qs, k=10, exact=True)
    measured = vector_index.recall_at(vector_index.search(index, qs, k=10), truth)
    return measured.select(F.col("wanted").alias("buscados"), (F.col("recall") >= 0.9).alias("recall_suficiente"))


# ------------------------------------------------------------------ DED-01 on wide rows
@register("ded_01_filas_anchas", "select distinct text, lang, source, n_chars from documents")
def q_ded_01(spark, d):
    """Distinct document rows without their ids: whole texts are not shuffled."""
    return filters.dedupe_wide(read_table(spark, d, "documents", "text", "lang", "source", "n_chars"))


# ------------------------------------------------------------------ RAG-08
def _insight_sql() -> str:
    parts = []
    kpi = registry.ORACLE["qry_33_kpis"]
    for m in ["total_contratos", "valor_total", "valor_promedio", "num_entidades", "num_departamentos",
              "num_proveedores"]:
        parts.append(f"select 'summary' as tipo_analisis, '{m}' as metrica, 'total' as clave, "
                     f"cast({m} as double) as valor from ({kpi}) k")
    cmp_ = registry.ORACLE["qry_15_educacion_vs_salud"]
    for m in ["num_contratos", "valor_total", "valor_pagado", "valor_pendiente"]:
        parts.append(f"select 'compare', '{m}', sector, cast({m} as double) from ({cmp_}) c")
    tr = registry.ORACLE["qry_03_mensual"]
    for m in ["num_contratos", "valor_total"]:
        parts.append(f"select 'trend', '{m}', printf('%04d-%02d', anno, mes), cast({m} as double) from ({tr}) t")
    an = registry.ORACLE["qry_18_atipicos_iqr"]
    parts.append(f"select 'anomaly', 'valor_contrato', id_contrato, cast(valor_contrato as double) from ({an}) a")
    return "\nunion all\n".join(parts)


@register("rag_08_analisis_insight", _insight_sql())
def q_rag_08(spark, d):
    return analysis.analyze(master(spark, d), "insight")


# ------------------------------------------------------------------ RAG-09
@register("rag_09_estado_corpus",
          "select source as categoria, count(*) as num_documentos from documents group by 1")
def q_rag_09(spark, d):
    return D.corpus_status(read_table(spark, d, "documents", "source"))
