"""SentencePiece BPE encoding and decoding in numpy, by rounds of merges.

A text is a row of symbols, at first its characters, in flat arrays over many words.
In each round every word finds its best pair (highest piece score), and its
leftmost occurrence is merged. Where no piece that could arise from
the merge ranks before it, all occurrences in the word are merged at
once, which gives the same result in fewer rounds. Merged symbols are compacted
away, and words without a pair leave. Characters without a piece become bytes.

Words are the stretches between places where no piece can cross: no piece of
the vocabulary has the space sign after another character, which is checked when
the vocabulary is loaded. Each worker keeps the words it has encoded and
forgets them all at a bound, which costs time only.

Null and empty texts give no ids and the text "". A text is never cut. Words
longer than ``LONG`` symbols use a heap instead of rounds, with the same result.
"""

import heapq
import re
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
LONG = 4000
KEPT_WORDS = 300_000
_CHUNK = 1_000_000
_NONE = np.int32(2**31 - 1)
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@dataclass
class Vocabulary:
    """Pieces of a BPE model with byte fallback, and the pairs that merge into them."""

    pieces: list[str]
    scores: list[float]
    kinds: list[str]  # normal, unknown, control, byte
    ids: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        normal = [i for i, kind in enumerate(self.kinds) if kind == "normal"]
        self.ids = {self.pieces[i]: i for i in normal}
        for piece in self.ids:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} crosses words")
        self.byte_ids = np.zeros(256, np.int32)
        for i, kind in enumerate(self.kinds):
            if kind == "byte":
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        symbols = dict(self.ids)
        for piece in self.ids:
            for char in piece:
                symbols.setdefault(char, len(self.pieces) + len(symbols))
        self.symbols = symbols
        order = sorted({self.scores[i] for i in normal}, reverse=True)
        rank_of = {score: rank for rank, score in enumerate(order)}
        keys, ranks, merged = [], [], []
        worst_first = {}
        tied = {}
        for piece, i in self.ids.items():
            rank = rank_of[self.scores[i]]
            tied[rank] = tied.get(rank, 0) + 1
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is None or right is None:
                    continue
                keys.append((left << 32) | right)
                ranks.append(rank)
                merged.append(i)
                for part in (left, right):
                    worst_first[part] = min(worst_first.get(part, rank), rank)
        by_key = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[by_key]
        self.ranks = np.array(ranks, np.int32)[by_key]
        self.merged = np.array(merged, np.int32)[by_key]
        self.at_once = np.array(
            [
                tied[rank] == 1 and worst_first.get(piece, rank + 1) > rank
                for rank, piece in zip(self.ranks.tolist(), self.merged.tolist())
            ],
            bool,
        )
        self.surface = [
            "" if kind == "control" else " ⁇ " if kind == "unknown" else piece
            for piece, kind in zip(self.pieces, self.kinds)
        ]

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair among the merges, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(left), -1)
        wanted = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, at, -1)


def load_vocabulary(path: str) -> Vocabulary:
    """Read the pieces of a model file; the library only reads the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = range(model.vocab_size())
    if model.normalize(" a  ﬁ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}ﬁ":
        raise ValueError("only models that keep texts as they are, with a space put first")
    if any(model.is_unused(i) for i in size):
        raise ValueError("unused pieces are not supported")
    kinds = [
        "unknown" if model.is_unknown(i) else "control" if model.is_control(i)
        else "byte" if model.is_byte(i) else "normal"
        for i in size
    ]
    return Vocabulary([model.id_to_piece(i) for i in size], [model.get_score(i) for i in size], kinds)


def split_pieces(text: str | None) -> list[str]:
    """Words of a text, each without the space sign that it starts with."""
    if not text:
        return []
    if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [word[1:] for word in _WORD.findall(SPACE + text.replace(" ", SPACE))]


class Encoder:
    """Encodes texts; keeps the ids of words it has seen in one flat array."""

    def __init__(self, vocabulary: Vocabulary, kept_words: int = KEPT_WORDS):
        self.vocabulary = vocabulary
        self.kept_words = kept_words
        self._forget()

    def _forget(self):
        self.index = {}
        self.flat = np.empty(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and how many belong to each text."""
        rows = [split_pieces(text) for text in texts]
        words = list(chain.from_iterable(rows))
        new = set(words).difference(self.index)
        if len(self.index) + len(new) > self.kept_words:
            self._forget()
            new = set(words)
        if new:
            self._learn(list(new))
        each = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        lengths = self.lengths[each]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[each] - (ends - lengths), lengths)
        bounds = np.cumsum([len(row) for row in rows])
        before = np.concatenate([[0], ends])[np.concatenate([[0], bounds]).astype(np.int64)]
        return self.flat[at], np.diff(before)

    def _learn(self, words: list[str]):
        flat, lengths = encode_words(self.vocabulary, [SPACE + word for word in words])
        first = len(self.index)
        self.index.update(zip(words, range(first, first + len(words))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat])


def encode_words(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and how many belong to each word."""
    # negative symbols are characters without a piece: -1 - code point
    text = "".join(words)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, which = np.unique(chars, return_inverse=True)
    start = np.array(
        [vocabulary.symbols.get(chr(c), -1 - int(c)) for c in kinds], np.int64
    )
    sizes = np.array([len(w) for w in words], np.int64)
    symbols = start[which] if len(kinds) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    done_symbols, done_owner = [], []
    for i in np.flatnonzero(sizes > LONG):
        mine = owner == i
        merged = _by_heap(vocabulary, symbols[mine])
        done_symbols.append(merged)
        done_owner.append(np.full(len(merged), i))
        symbols, owner = symbols[~mine], owner[~mine]
    while len(symbols):
        pairs = np.full(len(symbols), -1)
        inside = (owner[1:] == owner[:-1]) & (symbols[1:] >= 0) & (symbols[:-1] >= 0)
        at = np.flatnonzero(inside)
        pairs[at] = vocabulary.pair(symbols[at], symbols[at + 1])
        ranks = np.where(pairs >= 0, vocabulary.ranks[pairs], _NONE)
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        counts = np.diff(np.concatenate([heads, [len(symbols)]]))
        best = np.repeat(np.minimum.reduceat(ranks, heads), counts)
        over = best == _NONE
        if over.any():
            done_symbols.append(symbols[over])
            done_owner.append(owner[over])
            stay = ~over
            symbols, owner, pairs, ranks, best = (
                x[stay] for x in (symbols, owner, pairs, ranks, best)
            )
            if not len(symbols):
                break
        hits = np.flatnonzero(ranks == best)
        first = np.concatenate([[True], owner[hits][1:] != owner[hits][:-1]])
        chosen = first | vocabulary.at_once[pairs[hits]]
        hits = hits[chosen]
        # of overlapping occurrences (as in aaa) every other one counts, from the left
        joined = np.concatenate([[False], (hits[1:] == hits[:-1] + 1) & (owner[hits][1:] == owner[hits][:-1])])
        place = np.arange(len(hits))
        run = place - np.maximum.accumulate(np.where(joined, 0, place))
        hits = hits[run % 2 == 0]
        symbols[hits] = vocabulary.merged[pairs[hits]]
        keep = np.ones(len(symbols), bool)
        keep[hits + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    symbols = np.concatenate(done_symbols) if done_symbols else np.empty(0, np.int64)
    owner = np.concatenate(done_owner) if done_owner else np.empty(0, np.int64)
    by_word = np.argsort(owner, kind="stable")
    return _with_bytes(vocabulary, symbols[by_word], owner[by_word], len(words))


def _by_heap(vocabulary: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """Merge one long word, always the best pair, the leftmost of equals."""
    row = symbols.tolist()
    following = list(range(1, len(row))) + [-1]
    previous = list(range(-1, len(row) - 1))
    pair_at = {k: i for i, k in enumerate(vocabulary.keys.tolist())}
    ranks, merged = vocabulary.ranks.tolist(), vocabulary.merged.tolist()
    heap = []

    def offer(left):
        right = following[left]
        if right >= 0 and row[left] >= 0 and row[right] >= 0:
            i = pair_at.get((row[left] << 32) | row[right])
            if i is not None:
                heapq.heappush(heap, (ranks[i], left, row[left], row[right], merged[i]))

    for left in range(len(row) - 1):
        offer(left)
    gone = -(2**40)
    while heap:
        _, left, a, b, piece = heapq.heappop(heap)
        right = following[left]
        if row[left] != a or right < 0 or row[right] != b:
            continue
        row[left], row[right] = piece, gone
        following[left] = following[right]
        if following[right] >= 0:
            previous[following[right]] = left
        offer(left)
        if previous[left] >= 0:
            offer(previous[left])
    return np.array([s for s in row if s != gone], np.int64)


def _with_bytes(vocabulary, symbols, owner, words) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters without a piece by the ids of their bytes."""
    size = len(vocabulary.pieces)
    odd = np.flatnonzero((symbols < 0) | (symbols >= size))
    if len(odd):
        extra = {i: s for s, i in vocabulary.symbols.items() if i >= size}
        pieces = [
            extra[s].encode() if s >= 0 else chr(-1 - s).encode("utf-8", "surrogatepass")
            for s in symbols[odd].tolist()
        ]
        repeats = np.ones(len(symbols), np.int64)
        repeats[odd] = [len(p) for p in pieces]
        symbols, owner = np.repeat(symbols, repeats), np.repeat(owner, repeats)
        at = np.flatnonzero((symbols < 0) | (symbols >= size))
        symbols[at] = vocabulary.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    return symbols.astype(np.int32), np.bincount(owner, minlength=words).astype(np.int64)


class Decoder:
    """Texts from ids: the first space sign of a text goes, the others are spaces."""

    def __init__(self, vocabulary: Vocabulary):
        size = len(vocabulary.pieces)
        self.is_byte = np.zeros(size, bool)
        self.is_control = np.array([kind == "control" for kind in vocabulary.kinds])
        self.table = []
        for i, kind in enumerate(vocabulary.kinds):
            self.is_byte[i] = kind == "byte"
            self.table.append(
                bytes([int(vocabulary.pieces[i][3:5], 16)]) if kind == "byte"
                else vocabulary.surface[i].replace(SPACE, " ").encode()
            )
        self.starts_with_space = np.array([s.startswith(SPACE) for s in vocabulary.surface])

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        if self.is_control[ids].any():
            return self._with_replacements(ids)
        plain = b"".join(map(self.table.__getitem__, ids.tolist()))
        if self.starts_with_space[ids[0]]:
            plain = plain[1:]
        try:
            return plain.decode()
        except UnicodeDecodeError:
            return self._with_replacements(ids)

    def _with_replacements(self, ids: np.ndarray) -> str:
        """As ``decode``; each byte outside a whole character becomes U+FFFD."""
        out, at, ids, seen = [], 0, ids.tolist(), False
        while at < len(ids):
            end = at
            while end < len(ids) and self.is_byte[ids[end]]:
                end += 1
            if end == at:
                piece = self.table[ids[at]].decode()
                out.append(piece[1:] if not seen and self.starts_with_space[ids[at]] else piece)
                seen = seen or bool(piece)
                at += 1
                continue
            data, seen = b"".join(self.table[i] for i in ids[at:end]), True
            while data:
                for width in (1, 2, 3, 4):
                    try:
                        out.append(data[:width].decode())
                        data = data[width:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    data = data[1:]
            at = end
        return "".join(out)


@lru_cache(maxsize=2)
def _worker(path: str) -> tuple[Encoder, Decoder]:
    """One encoder and decoder for each Python worker and model file."""
    vocabulary = load_vocabulary(path)
    return Encoder(vocabulary), Decoder(vocabulary)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the ids of each text; the model file must lie on every executor."""

    def run(batches):
        encoder, _ = _worker(path)
        for batch in batches:
            for part in _parts(batch, text):
                flat, lengths = encoder.encode(part.column(text).to_pylist())
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield _appended(part, into, ids)

    kept = [f for f in df.schema if f.name != into]
    schema = T.StructType([*kept, T.StructField(into, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text that each row's ids stand for; null ids give ""."""

    def run(batches):
        _, decoder = _worker(path)
        for batch in batches:
            yield _appended(batch, into, _decoded(decoder, batch.column(ids)))

    kept = [f for f in df.schema if f.name != into]
    return df.mapInArrow(run, T.StructType([*kept, T.StructField(into, T.StringType())]))


def _decoded(decoder: Decoder, column: pa.Array) -> pa.Array:
    flat = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    return pa.array([decoder.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string())


def encode_and_decode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``decode`` of ``encode`` in one pass: one Python worker and one vocabulary per task."""

    def run(batches):
        encoder, decoder = _worker(path)
        for batch in batches:
            for part in _parts(batch, text):
                flat, lengths = encoder.encode(part.column(text).to_pylist())
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield _appended(_appended(part, ids, column), decoded, _decoded(decoder, column))

    kept = [f for f in df.schema if f.name not in (ids, decoded)]
    added = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]
    return df.mapInArrow(run, T.StructType([*kept, *added]))


def _parts(batch: pa.RecordBatch, text: str):
    """Slices of a batch with few characters, so that memory does not follow the batch."""
    sizes = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + _CHUNK, "right")))
        yield batch.slice(start, end - start)
        start = end


def _appended(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), column], [*names, name])


def digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the decoded text."""
    path = path or default_model()
    coded = encode_and_decode(documents.select("doc_id", "text"), path).drop("text")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
