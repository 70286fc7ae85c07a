"""Periodic runs of words, found in an enhanced suffix array by the branching-tandem test.

A run is a stretch of consecutive words with smallest period q (words q apart are equal)
that no neighbouring word extends, at least ``max(LEAST, EXPONENT * q)`` words long. The texts of
a task are handled together, as numpy arrays over all their words:

1. Suffixes of each text are sorted by prefix doubling. The ranks of every doubling are kept:
   they give the LCP of neighbours, and later rotations, by binary descent.
2. An LCP interval of depth d lies between the nearest smaller LCP values on either side.
   For all children of the interval but the largest, each suffix i asks by the inverse suffix
   array whether i + d or i - d lies in the interval but in another child. If so, two
   copies of d words follow each other and the word after them ends the repetition.
   No tree nodes are made, and each suffix is asked for O(log n) times.
3. Each such square is rotated to the left as far as the words go on to agree. Squares
   that end in the same stretch are one run; its period is the smallest of theirs.

The work is O(n log n) for a text of n words, whatever its runs are, and takes about 250 bytes
a word, for one text or ``BATCH_WORDS`` words at a time, whichever is more.

Null and empty texts have no words and no runs. Rows are handled one by one, so repeated ids,
null ids and repeated rows are each returned; ties between runs go to the smaller
start, then period. An empty table gives no rows; other columns are ignored.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.llm.words import split_words

LEAST = 6
EXPONENT = 4
BATCH_WORDS = 1 << 18
BATCH_BYTES = 1 << 23


def looped(n: int, doc_id: int | None) -> np.ndarray:
    """Which original word each place of a text holds after the given damage.

    One text in ten, by the checksum of its id (a null id reads as the empty text), goes
    round from some word on.
    """
    places = np.arange(n)
    mark = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if mark % 10 == 0 and n:
        kind = mark // 10
        first = kind % n
        period = 1 + (n - first) // (3 + kind % 8)
        places[first:] = first + np.arange(n - first) % period
    return places


def _ranks(keys: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array, and ranks by the first 1, 2, 4 .. words until all ranks differ.

    ``keys`` number the pairs (text, word) in the order of texts; ``ends`` is one past the
    last word of the text of each place.
    """
    size = len(keys)
    places = np.arange(size, dtype=np.int64)
    levels, width = [keys.astype(np.int32)], 1
    order = np.argsort(keys, kind="stable")
    while True:
        rank = levels[-1]
        ordered = rank[order]
        same = ordered[1:] == ordered[:-1]
        tied = np.zeros(size, bool)
        tied[1:] |= same
        tied[:-1] |= same
        if not tied.any():
            return order, levels
        # only suffixes that still share their rank are sorted again, inside their group
        where = np.flatnonzero(tied)
        open_ = order[where]
        after = open_ + width
        second = np.where(after < ends[open_], rank[np.minimum(after, size - 1)] + 1, 0)
        again = np.lexsort((second, rank[open_]))
        order = order.copy()
        order[where] = open_[again]
        first, second = rank[open_][again], second[again]
        fresh = np.ones(len(where), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        # a rank is the place of the first suffix of the group, so the others keep theirs
        heads = np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))
        finer = rank.copy() if len(levels) > 1 else _first_places(order, rank, places)
        finer[order[where]] = where[heads]
        levels.append(finer)
        width *= 2


def _first_places(order: np.ndarray, rank: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Ranks as the place of the first suffix with the same one."""
    ordered = rank[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    out = np.empty(len(rank), np.int32)
    out[order] = np.maximum.accumulate(np.where(new, places, 0))
    return out


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` of one text share (0 in different texts)."""
    total = np.zeros(len(a), np.int64)
    size = len(ends)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + total, b + total
        inside = np.maximum(x, y) + (1 << level) <= ends[np.minimum(a, b)]
        x, y = np.minimum(x, size - 1), np.minimum(y, size - 1)
        equal = inside & (levels[level][x] == levels[level][y])
        total[equal] += 1 << level
    return total


def _back(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words before ``a`` and before ``b`` (``a`` < ``b``, one text) that agree, going left."""
    total = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a - total - (1 << level), b - total - (1 << level)
        inside = x >= starts[a]
        equal = inside & (levels[level][np.maximum(x, 0)] == levels[level][np.maximum(y, 0)])
        total[equal] += 1 << level
    return total


def _smaller(values: np.ndarray, at: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place in ``at``: the nearest smaller value before it, and after it.

    Minima over 1, 2, 4 .. values are kept, and each place goes on by the largest step that
    holds no smaller value. Texts are parted by zeros, so no step is longer than a text.
    """
    size = len(values)
    minima = [values]
    while 1 << len(minima) <= longest and 1 << len(minima) <= size:
        last, half = minima[-1], 1 << (len(minima) - 1)
        minima.append(np.minimum(last[:-half], last[half:]))
    limit = values[at]
    left, right = at - 1, at + 1
    for level in range(len(minima) - 1, -1, -1):
        step, table = 1 << level, minima[level]
        from_ = left - step + 1
        free = (from_ >= 0) & (table[np.clip(from_, 0, len(table) - 1)] >= limit)
        left = np.where(free, left - step, left)
        free = (right + step <= size) & (table[np.clip(right, 0, len(table) - 1)] >= limit)
        right = np.where(free, right + step, right)
    return left, right


def _squares(order: np.ndarray, lcp: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Branching squares as (start, period), from all children but the largest."""
    size = len(order)
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    at = np.flatnonzero(lcp)
    if not len(at):
        return at, at
    longest = int((ends - starts).max())
    left, right = _smaller(lcp, at, longest)
    # lcp[p] is between ranks p - 1 and p, so an interval holds ranks left .. right - 1
    by = np.lexsort((at, right, left))
    at, left, right = at[by], left[by], right[by]
    new = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    last = np.concatenate([new[1:], [True]])
    # children start at the interval's first rank and at each boundary
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    child_from = np.concatenate([left[first], at])
    child_to = np.concatenate([at[first], np.where(last, right, np.roll(at, -1))])
    child_group = np.concatenate([np.arange(len(first)), group])
    length = child_to - child_from
    biggest = np.full(len(first), -1, np.int64)
    by_size = np.argsort(length, kind="stable")
    biggest[child_group[by_size]] = by_size
    small = np.ones(len(length), bool)
    small[biggest] = False
    child_from, child_to, child_group = child_from[small], child_to[small], child_group[small]
    depth = lcp[at[first]].astype(np.int64)[child_group]
    low, high = left[first][child_group], right[first][child_group]
    length = child_to - child_from
    owner = np.repeat(np.arange(len(length)), length)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
    suffix = order[child_from[owner] + inside]
    found_at, found_by = [], []
    for sign in (1, -1):
        other = suffix + sign * depth[owner]
        fits = (other >= starts[suffix]) & (other < ends[suffix])
        i, who, j = suffix[fits], owner[fits], place[other[fits]]
        there = (low[who] <= j) & (j < high[who])
        apart = (j < child_from[who]) | (j >= child_to[who])
        hit = there & apart
        period = depth[who[hit]]
        found_at.append(i[hit] if sign > 0 else i[hit] - period)
        found_by.append(period)
    return np.concatenate(found_at), np.concatenate(found_by)


def find_runs(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All runs of several texts as rows (place of the first word, length, period), sorted.

    ``words`` holds the numbers of the words of all texts in turn, and ``starts`` the place where the
    text of each word begins.
    """
    none = np.empty((0, 3), np.int64)
    size = len(words)
    if not size:
        return none
    ends = np.searchsorted(starts, starts, "right")
    _, keys = np.unique(starts.astype(np.int64) * (int(words.max()) + 1) + words, return_inverse=True)
    order, levels = _ranks(keys, ends)
    lcp = np.zeros(size, np.int64)
    lcp[1:] = _common(levels, order[:-1], order[1:], ends)
    lcp[1:][starts[order[1:]] != starts[order[:-1]]] = 0
    at, period = _squares(order, lcp.astype(np.int32), starts, ends)
    # a run holds its last square and the words before it that its length asks for
    need = np.maximum(LEAST, EXPONENT * period) - 2 * period
    fits = at - starts[at] >= need
    at, period = at[fits], period[fits]
    if not len(at):
        return none
    first = at - _back(levels, at, at + period, starts)
    length = at + 2 * period - first
    long = length >= np.maximum(LEAST, EXPONENT * period)
    first, length, period = first[long], length[long], period[long]
    by = np.lexsort((period, length, first))
    first, length, period = first[by], length[by], period[by]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (length[1:] != length[:-1])
    found = np.stack([first, length, period], 1)[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for the words that no run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth)[:n] == 0


def _parts(batches) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Stretches of rows with at most ``BATCH_BYTES`` of text, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(False)
        at = 0
        while at < batch.num_rows:
            upto, total, words = at, 0, 0
            while upto < batch.num_rows and (upto == at or total + sizes[upto] <= BATCH_BYTES):
                total += sizes[upto]
                upto += 1
            part, texts = batch.slice(at, upto - at), []
            for text in part.column("text"):
                texts.append(split_words(text.as_py()))
                words += len(texts[-1])
                if words >= BATCH_WORDS:
                    break
            yield part.slice(0, len(texts)), texts
            at += len(texts)


def _numbers(texts: list[list[bytes]]) -> np.ndarray:
    """A number for each distinct word."""
    flat = pa.array([w for words in texts for w in words], pa.binary())
    return flat.dictionary_encode().indices.to_numpy(False).astype(np.int64)


def runs_of(documents: DataFrame, loop: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``runs`` (start, length, period) by start then period, and ``collapsed``.

    ``collapsed`` is the text without the words that repeat a run's first period. ``loop``
    damages the texts first, as ``looped`` does.
    """

    def run(batches):
        for part, texts in _parts(batches):
            ids = part.column("doc_id").to_pylist()
            sizes = np.array([len(t) for t in texts], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            words = _numbers(texts)
            if loop:
                for i, (n, begin) in enumerate(zip(sizes, offsets)):
                    source = looped(int(n), ids[i])
                    words[begin : begin + n] = words[begin + source]
                    texts[i] = [texts[i][j] for j in source]
            found = find_runs(words, np.repeat(offsets[:-1], sizes))
            cuts = np.searchsorted(found[:, 0], offsets)
            runs, collapsed = [], []
            for i, text in enumerate(texts):
                own = found[cuts[i] : cuts[i + 1]] - [offsets[i], 0, 0]
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in own.tolist()])
                if len(own):
                    text = [w for w, keep in zip(text, kept_words(len(text), own)) if keep]
                collapsed.append(b" ".join(text).decode("utf-8", "surrogatepass"))
            stretch = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(runs, pa.list_(stretch)), pa.array(collapsed, pa.string())],
                ["doc_id", "runs", "collapsed"],
            )

    rows = documents.selectExpr(f"`{key}` AS doc_id", f"`{text}` AS text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    stretch = "struct<start:bigint,length:bigint,period:bigint>"
    return rows.mapInArrow(run, f"doc_id {kind}, runs array<{stretch}>, collapsed string")


def _stronger(a: Column, b: Column) -> Column:
    """Order of two runs: greater exact length over period, then smaller start and period."""
    wide = "decimal(38, 0)"
    left = a["length"].cast(wide) * b["period"].cast(wide)
    right = b["length"].cast(wide) * a["period"].cast(wide)
    before = (left > right) | (
        (left == right) & (F.struct(a["start"], a["period"]) < F.struct(b["start"], b["period"]))
    )
    return F.when(before, -1).when(a == b, 0).otherwise(1)


def digests(documents: DataFrame) -> DataFrame:
    """One row per document: its damaged text's runs, the strongest one, and checksums."""
    comma = F.lit(",")
    line = lambda r: F.concat(r["start"], comma, r["length"], comma, r["period"], F.lit("\n"))
    best = F.get(F.array_sort("runs", _stronger), F.lit(0))
    found = runs_of(documents, loop=True).withColumn("best", best)
    exponent = F.expr("1000 * best.length DIV best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        exponent.alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
