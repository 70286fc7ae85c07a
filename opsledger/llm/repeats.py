"""Remove long repeated spans of words: compacted paths of a De Bruijn graph.

Every run of ``WINDOW`` words is an edge from its first words to its last. Removed are the
words of each edge that also starts earlier: in a document with a smaller id, or before
in the same document. Only repeated edges matter, so most never leave their task:

1. Documents with equal word sequences are one; the first stands for all, and the others are
   removed whole if they hold an edge.
2. Every edge has an anchor, the run of ``ANCHOR`` words in it with the least hash; equal
   edges have equal anchors, and neighbours share them. Spark counts anchors; edges whose
   anchor occurs once cannot repeat.
3. The remaining edges are grouped by hash: how often, and the source coordinates (document,
   place) of the first. Two edges that follow each other at their sources and occur equally
   often lie on one nonbranching path; a join of the edges with their successors finds
   where paths start and end, and each path becomes one span of its source document.
4. A document keeps, of its remaining edges, those that its spans name as their
   source; every other one is a verified repeat, and its words go.

No list of a shingle's occurrences is ever gathered, so a passage in a third of all
documents is a partial aggregate like any other. Null and empty texts have no words.
Null ids sort first; rows with equal ids are ordered by a hash of the text, and rows equal in
id and text are one document, each returned. Words stay unchanged. An empty
table gives no rows, other columns are ignored. Windows are compared by 64-bit hashes.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsledger.functions.workspace import stored
from opsledger.llm.jaccard import rows_with_keys
from opsledger.llm.mixing import with_positions
from opsledger.llm.words import WordHashes, split_words, window_hashes

WINDOW = 20
ANCHOR = 8


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hashes in order, and for each window the number of its anchor."""
    windows = len(hashes) - WINDOW + 1
    if windows <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    runs = window_hashes(hashes, ANCHOR)
    span = WINDOW - ANCHOR + 1
    at = np.lib.stride_tricks.sliding_window_view(runs, span).argmin(1) + np.arange(windows)
    new = np.concatenate([[True], at[1:] != at[:-1]])
    return runs[at[new]], np.cumsum(new) - 1


def open_windows(hashes: np.ndarray, unique: np.ndarray) -> np.ndarray:
    """Places of the windows whose anchor is not among the unique ones."""
    found, number = anchors(hashes)
    lone = np.zeros(len(found), bool)
    lone[unique] = True
    return np.flatnonzero(~lone[number]) if len(found) else number


def _longs(arrays: list[np.ndarray], kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind, copy=False).view(kind)))


def _words(batches):
    """Parts of batches with the words of each text and their hashes."""
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 300):
            part = batch.slice(at, 300)
            if "packed" in part.schema.names:
                unpack = zstandard.ZstdDecompressor().decompress
                words = [unpack(z).split() for z in part.column("packed").to_pylist()]
            else:
                words = [split_words(t) for t in part.column("text").to_pylist()]
            yield part, words, [hashes.of(w) for w in words]


def _packed(rows: DataFrame) -> DataFrame:
    """``row`` and its text, compressed, so that a join moves less."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = batch.column("text").to_pylist()
            packed = [pack((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(packed, pa.binary())], ["row", "packed"])

    return rows.select("row", "text").mapInArrow(run, "row long, packed binary")


def _signed(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``row``, ``n_words``, ``n_anchors``, ``sequence`` (a hash) and ``sha``."""

    def run(batches):
        for part, words, hashes in _words(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row"),
                 pa.array([len(w) for w in words], pa.int64()),
                 pa.array([len(anchors(h)[0]) for h in hashes], pa.int64()),
                 pa.array([xxhash.xxh3_128_hexdigest(h.tobytes()) for h in hashes], pa.string()),
                 pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())],
                ["doc_id", "row", "n_words", "n_anchors", "sequence", "sha"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row long, n_words long, n_anchors long, sequence string, sha string"
    return stored(rows.mapInArrow(run, schema), "repeat-rows")


def _unique_anchors(rows: DataFrame) -> DataFrame:
    """For each row the numbers of its anchors that occur nowhere else."""

    def run(batches):
        for part, _, hashes in _words(batches):
            found = [anchors(h)[0].view(np.int64) for h in hashes]
            yield pa.RecordBatch.from_arrays([part.column("row"), _longs(found, np.int64)], ["row", "anchors"])

    each = rows.select("row", "text").mapInArrow(run, "row long, anchors array<long>")
    each = each.select("row", F.posexplode("anchors").alias("number", "anchor"))
    counts = each.groupBy("anchor").agg(
        F.count("*").alias("c"), F.min("row").alias("row"), F.min("number").alias("number")
    )
    lone = counts.filter("c = 1").select("row", "number")
    return stored(lone.groupBy("row").agg(F.collect_list("number").alias("unique")), "repeat-unique")


def _edges(rows: DataFrame, known: DataFrame, bits: int) -> DataFrame:
    """Each open window as (``edge``, ``spot``): the place of its document, then its own."""

    def run(batches):
        for part, _, hashes in _words(batches):
            unique = part.column("unique").to_pylist()
            places = [open_windows(h, np.array(u or [], np.int64)) for h, u in zip(hashes, unique)]
            edges = [window_hashes(h, WINDOW)[p].view(np.int64) for h, p in zip(hashes, places)]
            documents = part.column("place").to_pylist()
            spots = [(d << bits) + p for d, p in zip(documents, places)]
            yield pa.RecordBatch.from_arrays([_longs(spots, np.int64), _longs(edges, np.int64)], ["spots", "edges"])

    joined = _packed(rows).join(known, "row").select("packed", "place", "unique")
    listed = joined.mapInArrow(run, "spots array<long>, edges array<long>")
    zipped = listed.select(F.explode(F.arrays_zip("edges", "spots")).alias("e"))
    return zipped.select(F.col("e.edges").alias("edge"), F.col("e.spots").alias("spot"))


def source_paths(edges: DataFrame, bits: int) -> DataFrame:
    """Nonbranching paths as spans of their sources: ``place``, ``first``, ``last``, ``c``."""
    sources = edges.groupBy("edge").agg(F.count("*").alias("c"), F.min("spot").alias("spot"))
    sources = stored(sources.select("spot", "c"), "repeat-sources")
    here = sources.select("spot", "c", F.lit(True).alias("here"))
    after = sources.select((F.col("spot") + 1).alias("spot"), "c", F.lit(True).alias("before"))
    # a spot without a predecessor starts a path; one past a spot without a successor ends it
    met = here.join(after, ["spot", "c"], "full_outer").filter("here IS NULL OR before IS NULL")
    place = F.shiftright("spot", bits).alias("place")
    at = F.col("spot").bitwiseAND((1 << bits) - 1).alias("at")
    met = stored(met.select(place, at, "c", F.col("here").isNotNull().alias("starts")), "repeat-ends")
    order = Window.partitionBy("place", "starts", "c").orderBy("at")
    numbered = met.withColumn("number", F.row_number().over(order))
    keys = ["place", "c", "number"]
    heads = numbered.filter("starts").select(*keys, F.col("at").alias("first"))
    ends = numbered.filter("NOT starts").select(*keys, (F.col("at") - 1).alias("last"))
    return heads.join(ends, keys).select("place", "first", "last", "c")


def remove_repeats(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``row``, ``n_words``, ``n_removed``, ``kept_sha256`` and, where a part was
    removed, the ``kept`` text; null stands for the whole text or none."""
    rows = rows_with_keys(documents)
    signed = _signed(rows)
    leads = signed.groupBy("sequence").agg(F.min(F.struct("doc_id", "row")).alias("lead"))
    marked = signed.join(leads, "sequence")
    leading = F.col("row") == F.col("lead.row")
    marked = marked.withColumn("leading", leading & F.col("doc_id").eqNullSafe(F.col("lead.doc_id")))
    marked = stored(marked.drop("lead", "sequence"), "repeat-marked")
    unique = _unique_anchors(rows)
    ordered = marked.filter("leading AND n_anchors > 0").select("doc_id", "row", "n_anchors").distinct()
    order = [F.col("doc_id").asc_nulls_first(), F.col("row")]
    placed = with_positions(ordered, None, order, "repeat-order").withColumnRenamed("__pos", "place")
    known = placed.join(unique, "row", "left").filter(F.coalesce(F.size("unique"), F.lit(0)) < F.col("n_anchors"))
    known = stored(known.select("row", "place", "unique"), "repeat-known")
    # as many bits as the longest document needs, one to spare for the place past its end
    bits = 1 + (marked.agg(F.max("n_words")).first()[0] or 0).bit_length()
    paths = source_paths(_edges(rows, known, bits), bits)
    spans = paths.groupBy("place").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    touched = known.join(spans, "place", "left").select("row", "unique", "spans")

    def run(batches):
        for part, words, hashes in _words(batches):
            removed, kept = [], []
            for w, h, unique_here, spans_here in zip(
                words, hashes, part.column("unique").to_pylist(), part.column("spans").to_pylist()
            ):
                gone = _gone(h, unique_here or [], spans_here or [])
                removed.append(int(gone.sum()))
                kept.append(b" ".join(x for x, g in zip(w, gone.tolist()) if not g) if removed[-1] else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(removed, pa.int64()),
                 pa.array([None if k is None else k.decode("utf-8", "replace") for k in kept], pa.string()),
                 pa.array([None if k is None else hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                ["row", "part_removed", "kept", "part_sha"],
            )

    joined = _packed(rows).join(touched, "row").select("row", "packed", "unique", "spans")
    parts = joined.mapInArrow(run, "row long, part_removed long, kept string, part_sha string")
    parts = parts.filter("part_removed > 0").dropDuplicates(["row"])
    out = marked.join(parts, "row", "left")
    whole = ~F.col("leading") & (F.col("n_anchors") > 0)
    return out.select(
        "doc_id", "row", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("part_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("part_sha", "sha")).alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )


def _gone(hashes: np.ndarray, unique: list[int], spans: list[dict]) -> np.ndarray:
    """Which words are covered by an open window that is not its own source."""
    places = open_windows(hashes, np.array(unique, np.int64))
    source = np.zeros(len(hashes) + 1, np.int64)
    for span in spans:
        source[span["first"]] += 1
        source[span["last"] + 1] -= 1
    repeats = places[np.cumsum(source)[places] == 0]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, repeats, 1)
    np.add.at(cover, repeats + WINDOW, -1)
    return np.cumsum(cover)[:-1] > 0


def digests(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents).select("doc_id", "n_words", "n_removed", "kept_sha256")
