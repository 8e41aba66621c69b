"""Near-duplicate classes: improved consistent weighted sampling (ICWS) over
TF-IDF shingles, banded, verified by weighted Jaccard similarity.

Shingles are runs of five words (words without A-Z/a-z difference; a text of
fewer words, but not none, is one shingle). A shingle weighs its count in
the text times ``1 + ln((n + 1) / (df + 1)) / ln(n + 1)``, ``df`` being the
number of texts with it among all ``n``.

1. *Document frequencies.* Counted over all texts as sorted runs by shard;
   only shingles of two or more texts are stored (the rest have df 1).
2. *Signatures.* Two texts can reach the similarity only over shingles that
   both hold, so a text whose shared shingles (df >= 2) make up less than
   the threshold of it, by weight and by number, has no partner. That bound
   is exact; such texts skip the sampling. All others get ``bands x rows``
   consistent samples. Their shingle vectors go to files in the shared
   folder, once per distinct text of a task.
3. *Candidates.* Texts are told apart by a hash of their words, so copies
   are one node, however many. Members of a (band, key) bucket are compared
   with the bucket's pivot, the member with the largest shared part; those
   that stay apart from it, with the pivot of the rest, for ``ROUNDS``
   rounds. What is then still in another class than the bucket's largest is
   compared with every bucket member of another class. A pair is left out
   only if it cannot be a link: ``J(a, b) >= t`` needs ``|a & b| >=
   t / (1 + t) * (|a| + |b|)``, and ``|a & b|`` is at most the shared part
   of either text; beyond that, what a and b lack of their bucket's pivot,
   counted in ``GROUPS`` hash groups, they lack together at least the larger
   of the two in each group. So each candidate pair of a bucket is verified, ruled out
   or already joined, and a bucket of ``n`` similar texts costs about ``n``
   pairs instead of ``n * n / 2``.
4. *Verification.* The vectors of a pair are read from the mapped files; a
   pair is a link if its weighted or its plain Jaccard similarity reaches
   the threshold. Classes are the connected components of the links.

Sampling is probabilistic: a pair at similarity 0.8 shares a bucket with
probability ``1 - (1 - 0.8**rows)**bands``, 0.998 as set here, and more above.
That holds for weighted similarity. A pair that is a link by plain similarity
alone may be down to about two thirds by weight (frequent shared shingles,
unique edits) and then shares a bucket with probability 0.93.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import runs, shared
from .bytewords import NONSPACE, U64, Words, mix, ngrams, release, split_words, text_slices
from .components import components
from .util import fresh, with_text

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
ROUNDS = 2
GROUPS = 64  # hash groups in which missing shingles are counted
PORTION = 1_000_000
TABLE_BITS = 14  # size of the tables of random draws


def draws(samples: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Random draws of ICWS: r and c from Gamma(2, 1), b uniform, per sample a
    table that is indexed by bits of a multiplied shingle hash."""
    rng = np.random.default_rng(seed)
    shape = (samples, 1 << TABLE_BITS)
    return {"r": rng.gamma(2, 1, shape).astype(np.float32).clip(1e-3), "lnc": np.log(rng.gamma(2, 1, shape)).astype(np.float32),
            "b": rng.random(shape, np.float32), "odd": rng.integers(1, 1 << 63, samples, dtype=np.uint64) | U64(1)}


_drawn: dict[int, dict[str, np.ndarray]] = {}


def signatures(hashes: np.ndarray, weights: np.ndarray, first: np.ndarray, samples: int) -> np.ndarray:
    """``samples`` consistent samples of each text (texts x samples, uint64).

    Text ``i`` has the shingles ``first[i]:first[i + 1]`` (at least one).
    """
    if samples not in _drawn:
        _drawn[samples] = draws(samples)
    d = _drawn[samples]
    lnw = np.log(weights).astype(np.float32)
    start, sizes = first[:-1], np.diff(first)
    out = np.empty((len(start), samples), U64)
    for k in range(samples):
        at = ((hashes * d["odd"][k]) >> U64(64 - TABLE_BITS)).astype(np.int32)
        r = d["r"][k][at]
        t = np.floor(lnw / r + d["b"][k][at])
        a = d["lnc"][k][at] - r * (t - d["b"][k][at] + 1)
        least = np.repeat(np.minimum.reduceat(a, start), sizes)
        # the sample is the shingle of the least value (of several, the smallest hash) and its t
        value = mix(hashes + (t.astype(np.int64).astype(U64) << U64(1)))
        value[a != least] = U64(0xFFFFFFFFFFFFFFFF)
        out[:, k] = np.minimum.reduceat(value, start)
    return out


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(samples), bands), U64)
    for b in range(bands):
        acc = np.full(len(samples), b + 1, U64)
        for k in range(b * rows, (b + 1) * rows):
            acc = mix(acc * U64(0x9E3779B97F4A7C15) + samples[:, k])
        keys[:, b] = acc
    return keys


def text_keys(w: Words) -> np.ndarray:
    """Two 64-bit hashes of each text's word sequence (texts x 2)."""
    out = np.zeros((w.texts, 2), U64)
    count = w.counts()
    at = np.arange(len(w.hash), dtype=U64) - np.repeat(w.first[:-1], count).astype(U64)
    full = np.flatnonzero(count)
    if len(full):
        for k in range(2):
            part = mix(w.hash * U64(2 * k + 1) + mix(at + U64(77 + k)))
            out[full, k] = np.add.reduceat(part, w.first[full])
    return mix(out + count.astype(U64)[:, None])


def _bags(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in hash order: hashes, counts, ranges."""
    h, first = ngrams(w, SHINGLE)
    text = np.repeat(np.arange(w.texts), np.diff(first))
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    many = np.diff([*at, len(h)])
    return h[at], many, np.searchsorted(text[at], np.arange(w.texts + 1))


def _count(shards: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        portion = runs.Portion(shards, PORTION)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0), 1 << 20):
                yield from portion.add(_bags(split_words(data, offsets, NONSPACE))[0])
        yield from portion.flush()
    return count


def _store_df(folder: str):
    def store(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        keys, counts = runs.merged(group)
        often = counts >= 2
        shared.put(f"{folder}/shingles-{shard}", keys[often])
        shared.put(f"{folder}/df-{shard}", counts[often].astype(np.uint32))
        release()
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": [int(often.sum())]})
    return store


def _frequencies(folder: str, shards: int, hashes: np.ndarray) -> np.ndarray:
    distinct, place = np.unique(hashes, return_inverse=True)
    df = np.ones(len(distinct), np.int64)
    for s, a, b in runs.by_shard(runs.shard_of(distinct, shards)):
        at, there = runs.find(shared.mapped(f"{folder}/shingles-{s}", U64), distinct[a:b])
        df[a:b][there] = shared.mapped(f"{folder}/df-{s}", np.uint32)[at[there]]
    return df[place]


SIGN_SCHEMA = "row long, hi long, lo long, bands array<long>, file string, at long, n int, shared int, weight double, shared_weight double"


def _sign(folder: str, shards: int, texts: int, similarity: float, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"vectors-{task.partitionId()}-{task.taskAttemptId()}"
        vectors: list[bytes] = []
        written, part, seen = 0, 0, {}
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1), 1 << 20):
                w = split_words(data, offsets, NONSPACE)
                keys = text_keys(w)
                h, many, first = _bags(w)
                df = _frequencies(folder, shards, h)
                weight = many * (1 + np.log((texts + 1) / (df + 1)) / np.log(texts + 1))
                n = len(keys)
                text = np.repeat(np.arange(n), np.diff(first))
                both = df >= 2
                total, common = (np.bincount(text, x, n) for x in (weight, weight * both))
                plain, common_n = np.diff(first), np.bincount(text[both], minlength=n)
                may = (plain > 0) & ((common >= similarity * total * (1 - 1e-9)) | (common_n >= similarity * plain))
                alive = np.flatnonzero(may)
                bucket: list = [None] * n
                place: list = [(None,) * 6] * n
                new = [i for i in alive if (int(keys[i, 0]), int(keys[i, 1])) not in seen]
                if len(new):
                    take = np.concatenate([np.arange(first[i], first[i + 1]) for i in new])
                    ranges = np.concatenate(([0], np.cumsum(plain[new])))
                    found = band_keys(signatures(h[take], weight[take], ranges, bands * rows), bands, rows).astype(np.int64)
                    for i, k in zip(new, found, strict=True):
                        block = h[first[i]:first[i + 1]].tobytes() + weight[first[i]:first[i + 1]].astype(np.float32).tobytes()
                        block += bytes(-len(block) % 8)
                        seen[int(keys[i, 0]), int(keys[i, 1])] = (k, (f"{name}-{part}", written, int(plain[i]), int(common_n[i]), float(total[i]), float(common[i])))
                        vectors.append(block)
                        written += len(block)
                for i in alive:
                    bucket[i], place[i] = seen[int(keys[i, 0]), int(keys[i, 1])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(keys[:, 0].astype(np.int64)), pa.array(keys[:, 1].astype(np.int64)),
                    pa.array(bucket, pa.list_(pa.int64())), *(pa.array([p[c] for p in place], t) for c, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64())))],
                    names=["row", "hi", "lo", "bands", "file", "at", "n", "shared", "weight", "shared_weight"])
                if written > 16 << 20:  # a new file; what was seen stays known while it is small
                    shared.put(f"{folder}/{name}-{part}", b"".join(vectors))
                    vectors, written, part = [], 0, part + 1
                    if len(seen) > 20_000:
                        seen = {}
        if vectors:
            shared.put(f"{folder}/{name}-{part}", b"".join(vectors))
        del vectors, seen
        release()
    return sign


def _vector(folder: str, file: str, at: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    whole = shared.mapped(f"{folder}/{file}", np.uint8)
    return whole[at:at + 8 * n].view(U64), whole[at + 8 * n:at + 12 * n].view(np.float32)


def similarities(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Weighted and plain Jaccard similarity of two shingle vectors."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    most = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64)) - least
    return least / most if most else 0.0, len(i) / max(len(a[0]) + len(b[0]) - len(i), 1)


def _verify(folder: str, similarity: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = batch.to_pydict()
            keep, weighted = [], []
            for k in range(batch.num_rows):
                a = _vector(folder, *(cols[c][k] for c in ("a_file", "a_at", "a_n")))
                b = _vector(folder, *(cols[c][k] for c in ("b_file", "b_at", "b_n")))
                x, y = similarities(a, b)
                if max(x, y) >= similarity - 1e-6:
                    keep.append(k)
                    weighted.append(x)
            got = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([got.column(0), got.column(1), pa.array(weighted, pa.float64())], names=["a", "b", "similarity"])
    return verify


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id`` (the smallest id
    of its class), ``class_texts`` (distinct texts in it), ``is_kept`` (true
    for the document that stands for its class), ``text_hi``, ``text_lo``
    (hash of its words).

    Null texts are empty texts; all texts without a word are one class, as
    copies of each other. A null id comes after all others, so ``class_id``
    is null only where a class has no other id. Rows that repeat the kept
    id and text are all marked (:func:`keep_one` leaves one of them). Other
    columns are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    folder = shared.new_folder(spark, "icws")
    rows_df = docs.select(F.col(doc_id).cast("long").alias("row"), F.col(text).cast("string").alias("text"))
    shards = runs.shards_for(rows_df.rdd.getNumPartitions())
    counted = rows_df.select("text").mapInArrow(_count(shards), runs.RUN_SCHEMA)
    stored = {r["shard"] for r in counted.groupBy("shard").applyInArrow(_store_df(folder), "shard int, n long").collect()}
    for s in set(range(shards)) - stored:
        shared.put(f"{folder}/shingles-{s}", b"")
        shared.put(f"{folder}/df-{s}", b"")
    texts = rows_df.count()
    signed = shared.written(rows_df.mapInArrow(_sign(folder, shards, texts, similarity, bands, rows), SIGN_SCHEMA), "signed", folder)

    # one node per distinct text that may have partners: any of its places
    places = signed.where("bands is not null").groupBy("hi", "lo").agg(
        F.min(F.struct("file", "at", "n", "bands", *SIZES)).alias("p"))
    nodes = shared.written(places.select(F.xxhash64("hi", "lo").alias("node"), "hi", "lo", "p.file", "p.at", "p.n", "p.bands", *(F.col(f"p.{x}").alias(x) for x in SIZES)), "nodes", folder)
    members = nodes.select("node", "n", *SIZES, F.posexplode("bands").alias("band", "key")).select("node", "n", *SIZES, "band", F.xxhash64("band", "key").alias("bucket"))
    # buckets of one text hold no pair
    many = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    members = shared.written(members.join(many, "bucket"), "members", folder)
    labels = classes(nodes, members, folder, similarity)

    # texts in classes of several; all other texts are their own class
    known = nodes.select("node", "hi", "lo").join(labels, "node").select("hi", "lo", F.col("label"))
    first = F.struct(F.col("row").isNull().alias("none"), "row", "hi", "lo")
    per_text = signed.groupBy("hi", "lo").agg(F.min(first).alias("first"))
    per_text = per_text.join(known, ["hi", "lo"], "left").withColumn("label", F.coalesce("label", F.xxhash64("hi", "lo")))
    per_class = per_text.groupBy("label").agg(F.min("first").alias("first"), F.count("*").alias("class_texts"))
    mapping = per_text.select("hi", "lo", "label").join(per_class, "label").select("hi", "lo", "first", "class_texts")
    return signed.select("row", "hi", "lo").join(mapping, ["hi", "lo"]).select(
        F.col("row").alias("doc_id"), F.col("first.row").alias("class_id"), "class_texts",
        (F.col("row").eqNullSafe(F.col("first.row")) & (F.col("hi") == F.col("first.hi")) & (F.col("lo") == F.col("first.lo"))).alias("is_kept"),
        F.col("hi").alias("text_hi"), F.col("lo").alias("text_lo"))


def with_text_keys(docs: DataFrame, text: str, names: tuple[str, str]) -> DataFrame:
    """``docs`` and the two hashes of its words."""
    columns = docs.columns
    src, at = with_text(docs, columns, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(at)):
                keys = text_keys(split_words(data, offsets, NONSPACE)).astype(np.int64)
                kept = [batch.column(i).slice(lo, hi - lo) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=[*columns, *names])

    return src.mapInArrow(run, T.StructType([*docs.schema, *(T.StructField(x, T.LongType()) for x in names)]))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """``docs`` with one document of each near-duplicate class, all columns."""
    hi, lo, row, n = (fresh(docs, x) for x in ("kept_hi", "kept_lo", "kept_row", "kept_n"))
    kept = near_duplicates(docs, text, doc_id, **settings).where("is_kept").select(
        F.col("doc_id").alias(row), F.col("text_hi").alias(hi + "_k"), F.col("text_lo").alias(lo + "_k")).distinct()
    keyed = with_text_keys(docs, text, (hi, lo))
    joined = keyed.join(kept, (keyed[hi] == kept[hi + "_k"]) & (keyed[lo] == kept[lo + "_k"]) & keyed[doc_id].cast("long").eqNullSafe(kept[row]))
    one = Window.partitionBy(hi, lo, row).orderBy(F.lit(0))
    return joined.withColumn(n, F.row_number().over(one)).where(F.col(n) == 1).select(*docs.columns)


#: Of a text: shingles and weight that other texts hold too, and all weight.
SIZES = ("shared", "weight", "shared_weight")


def _possible(similarity: float):
    """Whether two members ``a_*`` and ``b_*`` can reach the similarity."""
    least = similarity / (1 + similarity) * (1 - 1e-6)
    plain = F.least("a_shared", "b_shared") >= least * (F.col("a_n") + F.col("b_n"))
    weighted = F.least("a_shared_weight", "b_shared_weight") >= least * (F.col("a_weight") + F.col("b_weight"))
    return plain | weighted


def _missing(folder: str):
    """What a member lacks of its bucket's pivot, by hash group, and what it
    shares with other texts beyond the pivot: numbers and weights."""
    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = batch.to_pydict()
            out: list[list] = [[], [], [], []]
            for k in range(batch.num_rows):
                h, w = _vector(folder, *(cols[c][k] for c in ("file", "at", "n")))
                ph, pw = _vector(folder, *(cols[f"p_{c}"][k] for c in ("file", "at", "n")))
                _, i, j = np.intersect1d(h, ph, assume_unique=True, return_indices=True)
                both = np.minimum(w[i], pw[j]).astype(np.float64)
                lack = pw.astype(np.float64)
                lack[j] -= both
                plain = np.ones(len(ph))
                plain[j] = 0
                group = (mix(ph) >> U64(64 - 6)).astype(np.int64)
                out[0].append(np.bincount(group, plain, GROUPS))
                out[1].append(np.bincount(group, lack, GROUPS))
                out[2].append(cols["shared"][k] - len(i))
                out[3].append(cols["shared_weight"][k] - float(both.sum()))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("bucket", "node", "p_n", "p_weight")]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.list_(pa.float64())) for x in out[:2]), pa.array(out[2], pa.float64()), pa.array(out[3], pa.float64())],
                                             names=["bucket", "node", "p_n", "p_weight", "lack", "lack_weight", "extra", "extra_weight"])
    return missing


def _possible_by_pivot(similarity: float):
    """The same as ``_possible`` with the closer bound by the pivot ``p``:
    ``|a & b| <= |p| - (lacked together) + min(extra a, extra b)``. Weights
    are stored as 32-bit floats, hence the allowance."""
    least = similarity / (1 + similarity) * (1 - 1e-6)

    def bound(size: str, lack: str, extra: str):
        together = F.aggregate(F.zip_with(f"a_{lack}", f"b_{lack}", lambda x, y: F.greatest(x, y)), F.lit(0.0), lambda acc, x: acc + x)
        return F.col(f"a_{size}") - together + F.greatest(F.least(f"a_{extra}", f"b_{extra}"), F.lit(0.0))

    plain = bound("p_n", "lack", "extra") >= least * (F.col("a_n") + F.col("b_n"))
    weighted = bound("p_weight", "lack_weight", "extra_weight") * (1 + 1e-4) >= least * (F.col("a_weight") + F.col("b_weight"))
    return plain | weighted


def classes(nodes: DataFrame, members: DataFrame, folder: str, similarity: float) -> DataFrame:
    """``(node, label)`` of nodes in components of two or more."""
    place = nodes.select("node", "file", "at", "n")
    sizes = ("n", *SIZES)

    def side(df: DataFrame, x: str, *more: str) -> DataFrame:
        return df.select("bucket", F.col("node").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in (*sizes, *more)))

    def links(pairs: DataFrame, name: str) -> DataFrame:
        pairs = pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for x in ("a", "b"):
            pairs = pairs.join(place.select(F.col("node").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("file", "at", "n"))), x)
        pairs = pairs.select("a", "b", *(f"{x}_{c}" for x in "ab" for c in ("file", "at", "n"))).repartition("b", "a")
        return shared.written(pairs.mapInArrow(_verify(folder, similarity), "a long, b long, similarity double"), name, folder)

    def labelled(df: DataFrame, label: DataFrame) -> DataFrame:
        return df.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))

    found, rest = None, members
    for k in range(ROUNDS):
        best = F.max(F.struct((F.col("shared") / F.col("n")).alias("part"), "node", *sizes)).alias("p")
        pivot = rest.groupBy("bucket").agg(best).select("bucket", *(F.col(f"p.{c}").alias(c) for c in ("node", *sizes)))
        pivot = shared.written(pivot, f"pivots-{k}", folder)
        new = links(side(rest, "a").join(side(pivot, "b"), "bucket").where(_possible(similarity)), f"links-{k}")
        found = new if found is None else found.unionByName(new)
        label = shared.written(components(found.select("a", "b"), folder, f"cc-{k}"), f"labels-{k}", folder)
        # a member stays if it is in another class than this round's pivot
        of_pivot = labelled(pivot.select("bucket", "node"), label).select("bucket", F.col("label").alias("of_pivot"))
        rest = shared.written(labelled(rest, label).join(of_pivot, "bucket").where("label != of_pivot").select("bucket", "node", *sizes), f"rest-{k}", folder)
        if rest.isEmpty():
            break
    # what is still apart from the largest class of its bucket, against the bucket
    tagged = shared.written(labelled(members, label), "tagged", folder)
    counts = tagged.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    largest = counts.groupBy("bucket").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("labels")).where("labels > 1").select("bucket", F.col("top.label").alias("top"))
    torn = tagged.join(largest, "bucket").join(nodes.select("node", "bands", "file", "at"), "node")
    centre = torn.groupBy("bucket").agg(F.max(F.struct((F.col("shared") / F.col("n")).alias("part"), "node", "file", "at", "n", "weight")).alias("p"))
    centre = centre.select("bucket", *(F.col(f"p.{c}").alias(f"p_{c}") for c in ("file", "at", "n", "weight")))
    torn = shared.written(torn.join(centre, "bucket"), "torn", folder)
    lacks = ("p_n", "p_weight", "lack", "lack_weight", "extra", "extra_weight")
    lack = torn.select("bucket", "node", "file", "at", "n", "shared", "shared_weight", "p_file", "p_at", "p_n", "p_weight").repartition("node", "bucket").mapInArrow(
        _missing(folder), "bucket long, node long, p_n int, p_weight double, lack array<double>, lack_weight array<double>, extra double, extra_weight double")
    torn = shared.written(torn.drop("p_n", "p_weight", "p_file", "p_at").join(lack, ["bucket", "node"]), "measured", folder)
    apart = side(torn.where("label != top"), "a", "label", "band", "bands", *lacks)
    others = side(torn, "b", "label", "bands", "top", *lacks).withColumnRenamed("bucket", "b_bucket")
    # a pair that shares several buckets is compared in the first of them, one of two apart members once
    once = (F.array_position(F.zip_with("a_bands", "b_bands", lambda x, y: x == y), True) == F.col("a_band") + 1) & ((F.col("b_label") == F.col("b_top")) | (F.col("a") < F.col("b")))
    cross = apart.join(others, (F.col("bucket") == F.col("b_bucket")) & (F.col("a_label") != F.col("b_label")) & once & _possible(similarity) & _possible_by_pivot(similarity))
    last = links(cross, "links-cross")
    if last.isEmpty():
        return label
    return shared.written(components(found.unionByName(last).select("a", "b"), folder, "cc-all"), "labels", folder)
