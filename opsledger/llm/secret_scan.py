"""Find secrets in texts: three fixed rules, and a character network for the rest.

Every run of 16 or more key characters is a candidate, and of 6 or more that holds or closely
follows a word such as password, token or key; of a run that rules cover in part,
each part so long that they leave. A convolutional network in
numpy reads the characters of the candidate and its context: filters of seven
characters, the maximum of each filter before, in and after the candidate, and a
logistic layer. Candidates of more than 48 characters are read in windows of 48 and of 24 that
overlap by half; the highest score of a window counts, so that what surrounds a key in a long path
does not hide it, and the span is the whole candidate. The network is trained on labelled findings: the
candidates of all texts (of long ones at most ``TRAIN_WINDOWS`` windows, by hash), of
which at most ``TRAIN_FINDINGS`` distinct ones of either label are taken in order of a hash; a
candidate counts as a secret where a rule covers it, and what rules leave of a run is not learnt
from. The words around
half of the findings are blanked, so that the shape alone must do. Scores are
calibrated on findings that were held out. The threshold may not exceed the score that
``RECALL`` of the held-out secrets reach; it lies halfway from there to the score that ``OTHERS``
of the other held-out findings stay below, or at the former if that is lower. The network tells
the recall it reached on the held-out secrets.

Candidates that no rule covers and that reach the threshold are added as kind
``network``; what the rules find stays. With fewer than ``LEAST_FINDINGS`` secrets or as few other
findings (or hardly a secret among the held-out or the other ones) there is too little to learn
from, and only the rules apply. Null and empty texts have no spans; whole texts are read. Spans are in
code points, the end is exclusive. Repeated rows are scanned each; an empty table
gives no rows; other columns stay as they are.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.functions.workspace import stored

TRAIN_FINDINGS = 3000
TRAIN_WINDOWS = 4
LEAST_FINDINGS = 8
RECALL = 0.98
OTHERS = 0.995
MASK = "[SECRET]"
# The rules
KINDS = ("assign", "access", "hex", "network")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_CHARS = 6
_LEAST, _LEAST_HINTED = 16, 6
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer")
_HINT = re.compile(
    r"(?:[Pp](?i:ass(?:w(?:or)?d|phrase|code)?|wd)|[Ss](?i:ecret)|[Tt](?i:oken)|[Kk](?i:ey)"
    r"|[Cc](?i:redential)|[Aa](?i:uth)|[Bb](?i:earer))[sS]?(?![A-Za-z])"
)
_REACH = 12
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
_LAST_RUN = re.compile(r"[A-Za-z0-9+/_.=-]*\Z")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_BEFORE, _INSIDE, _AFTER, _WIDTH, _FILTERS = 24, 48, 12, 7, 24
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-:;\"'`<>()[]{},!?#$%&*@|~^\\ \n\t"
_OTHER = len(_ALPHABET) + 1
_CODES = np.full(0x110000, _OTHER, np.uint8)
_CODES[[ord(c) for c in _ALPHABET]] = np.arange(1, _OTHER)
_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SEGMENTS = ((0, _BEFORE), (_BEFORE, _BEFORE + _INSIDE), (_BEFORE + _INSIDE, _BEFORE + _INSIDE + _AFTER))


def rule_spans(text: str | None) -> list[tuple[str, int, int]]:
    """What the rules find, by start, then kind as listed."""
    if not text:
        return []
    found = []
    if "=" in text or ":" in text:
        for match in _ASSIGN.finditer(text):
            if len(match[2]) >= _ASSIGN_CHARS:
                found.append(("assign", match.start(), match.end()))
    for start, end in candidates(text):
        run = text[start:end]
        found += [("access", start + m.start(), start + m.end()) for m in _ACCESS.finditer(run)]
        found += [("hex", start + m.start(), start + m.end()) for m in _HEX.finditer(run)]
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Maximal runs of key characters; both later rules match inside such runs only."""
    return [match.span() for match in _CANDIDATE.finditer(text)]


def hinted(text: str) -> list[tuple[int, int]]:
    """Runs below the length of a candidate that hold or closely follow a word for a secret."""
    lower = text.lower()
    if not any(hint in lower for hint in _HINTS):
        return []
    found = set()
    for hint in _HINT.finditer(text):
        low = max(0, hint.start() - _LEAST)
        low += _LAST_RUN.search(text[low : hint.start()]).start()
        # a run that starts within reach is either whole up to the limit or too long there
        for run in _RUN.finditer(text, low, hint.end() + _REACH + _LEAST):
            start, end = run.span()
            if start <= hint.end() + _REACH and end > hint.end() and end - start < _LEAST:
                found.add((start, end))
    return sorted(found)


def pieces(text: str, spans: list[tuple[str, int, int]]) -> tuple[list, list, list]:
    """The candidates cut by the rules' spans: what is covered, what is left of covered runs, untouched runs."""
    covered, left, free = [], [], []
    merged = []
    for _, start, end in spans:  # by start
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    first = 0
    runs = [(*run, _LEAST) for run in candidates(text)] + [(*run, _LEAST_HINTED) for run in hinted(text)]
    for start, end, least in sorted(runs):
        while first < len(merged) and merged[first][1] <= start:
            first += 1
        at, k = start, first
        while k < len(merged) and merged[k][0] < end:
            if merged[k][0] - at >= least:
                left.append((at, merged[k][0]))
            covered.append((max(start, merged[k][0]), min(end, merged[k][1])))
            at, k = merged[k][1], k + 1
        if k == first:
            free.append((start, end))
        elif end - at >= least:
            left.append((at, end))
    return covered, left, free


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """What the network reads of a candidate: all of it, or windows of two sizes, each size covering it."""
    if end - start <= _INSIDE:
        return [(start, end)]
    sizes = (_INSIDE, _INSIDE // 2)
    return [(at, at + size) for size in sizes for at in [*range(start, end - size, size // 2), end - size]]


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Codes of a window and its context."""
    inside = text[start:end]
    before = text[max(0, start - _BEFORE) : start]
    after = text[end : end + _AFTER]
    codes = np.zeros(_BEFORE + _INSIDE + _AFTER, np.uint8)
    for at, part in ((_BEFORE - len(before), before), (_BEFORE, inside), (_BEFORE + _INSIDE, after)):
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes[at : at + len(part)] = _CODES[points]
    return codes


@dataclass
class Network:
    """Filters (width, code, filter), their bias, the logistic layer, calibration, threshold, held-out recall."""

    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0
    recall: float = 0.0

    def features(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of each filter in each segment, and where it is."""
        padded = np.pad(codes, ((0, 0), (_WIDTH // 2, _WIDTH // 2)))
        length = codes.shape[1]
        out = np.zeros((*codes.shape, _FILTERS), np.float32)
        for step in range(_WIDTH):
            out += self.filters[step][padded[:, step : step + length]]
        tops, places = [], []
        for start, end in _SEGMENTS:
            place = out[:, start:end].argmax(axis=1) + start
            places.append(place)
            tops.append(np.take_along_axis(out, place[:, None, :], 1)[:, 0])
        top = np.concatenate(tops, 1) + np.tile(self.bias, len(_SEGMENTS))
        return np.maximum(top, 0), np.concatenate(places, 1)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return self.features(codes)[0] @ self.weights + self.offset

    def scores(self, codes: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * self.logits(codes) + self.shift)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(codes: np.ndarray, labels: np.ndarray, seed: int = 7, epochs: int = 12) -> Network | None:
    """Train on three quarters of the findings, calibrate and set the threshold on the rest."""
    if labels.sum() < LEAST_FINDINGS or (1 - labels).sum() < LEAST_FINDINGS:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    held, used = order[: len(order) // 4], order[len(order) // 4 :]
    if labels[held].sum() < 2 or labels[used].sum() < 4:
        return None
    codes = codes.copy()
    blank = rng.random(len(codes)) < 0.5
    codes[blank, :_BEFORE] = 0
    codes[blank, _BEFORE + _INSIDE :] = 0
    net = Network(
        rng.normal(0, 0.1, (_WIDTH, _OTHER + 1, _FILTERS)).astype(np.float32),
        np.zeros(_FILTERS, np.float32),
        rng.normal(0, 0.1, _FILTERS * len(_SEGMENTS)).astype(np.float32),
        0.0,
    )
    share = labels[used].mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (net.filters, net.bias, net.weights, np.zeros(1))]
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            step += 1
            x, y = codes[batch], labels[batch]
            top, place = net.features(x)
            error = (_sigmoid(top @ net.weights + net.offset) - y) * weight[batch] / len(batch)
            back = error[:, None] * net.weights * (top > 0)
            grad = np.zeros_like(net.filters)
            padded = np.pad(x, ((0, 0), (_WIDTH // 2, _WIDTH // 2)))
            rows = np.arange(len(x))[:, None]
            column = np.broadcast_to(np.tile(np.arange(_FILTERS), len(_SEGMENTS)), place.shape)
            for shift in range(_WIDTH):
                np.add.at(grad[shift], (padded[rows, place + shift], column), back)
            grads = (
                grad,
                back.sum(0).reshape(len(_SEGMENTS), _FILTERS).sum(0),
                top.T @ error + 1e-4 * net.weights,
                np.array([error.sum()]),
            )
            moves = []
            for (first, second), g in zip(moments, grads):
                first += 0.1 * (g - first)
                second += 0.01 * (g * g - second)
                rate = 0.01 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                moves.append(rate * first / (np.sqrt(second) + 1e-8))
            net.filters -= moves[0].astype(np.float32)
            net.bias -= moves[1].astype(np.float32)
            net.weights -= moves[2].astype(np.float32)
            net.offset -= float(moves[3][0])
    logits, truth = net.logits(codes[held]), labels[held]
    net.scale, net.shift = _calibrate(logits, truth)
    scores = net.scores(codes[held])
    secrets = np.sort(scores[truth == 1])
    highest = float(secrets[int(np.floor((1 - RECALL) * len(secrets)))])
    others = float(np.quantile(scores[truth == 0], OTHERS)) if (truth == 0).any() else 0.0
    net.threshold = min(highest, (highest + others) / 2)
    net.recall = float((secrets >= net.threshold).mean())
    return net


def _calibrate(logits: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the truth on the logit, with a weak pull to (1, 0)."""
    scale, shift = 1.0, 0.0
    for _ in range(300):
        error = _sigmoid(scale * logits + shift) - truth
        scale -= 0.1 * (float((error * logits).mean()) + 0.01 * (scale - 1))
        shift -= 0.1 * (float(error.mean()) + 0.01 * shift)
    return max(scale, 1e-3), shift


def labelled_findings(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the candidates of some texts, and 1 where a rule covers one."""
    codes, labels = [], []
    for text in texts:
        if not text:
            continue
        covered, _, free = pieces(text, rule_spans(text))
        for label, parts in ((1.0, covered), (0.0, free)):
            for start, end in parts:
                read = [encode(text, a, b) for a, b in windows(start, end)]
                if len(read) > TRAIN_WINDOWS:
                    read = sorted(read, key=lambda c: xxhash.xxh3_64_intdigest(c.tobytes()))[:TRAIN_WINDOWS]
                codes += read
                labels += [label] * len(read)
    size = _BEFORE + _INSIDE + _AFTER
    return np.array(codes, np.uint8).reshape(len(codes), size), np.array(labels, np.float32)


def findings(df: DataFrame, text: str = "text") -> DataFrame:
    """Distinct candidates as (``label``, ``codes``, ``mark``), the last a hash of the codes."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                codes, labels = labelled_findings(batch.slice(at, 500).column("t").to_pylist())
                rows = [c.tobytes() for c in codes]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(labels.astype(np.int32)),
                        pa.array(rows, pa.binary()),
                        pa.array([xxhash.xxh3_64_intdigest(r) >> 1 for r in rows], pa.int64()),
                    ],
                    ["label", "codes", "mark"],
                )

    texts = df.select(F.col(text).alias("t"))
    return texts.mapInArrow(run, "label int, codes binary, mark long").distinct()


def fit(df: DataFrame, text: str = "text", most: int = TRAIN_FINDINGS) -> Network | None:
    """Train on at most ``most`` findings of each label, in order of a hash."""
    found = stored(findings(df, text), "secret-findings")
    codes, labels = [], []
    for row in found.groupBy("label").agg(F.count("*").alias("n")).orderBy("label").collect():
        # a little more than enough by hash, so that each task sends few rows
        share = min(1.0, (1.5 * most + 100) / row["n"])
        chosen = found.filter(F.col("label") == row["label"]).filter(F.col("mark") <= min(2**63 - 1, int(share * 2**63)))
        for finding in chosen.orderBy("mark", "codes").limit(most).collect():
            codes.append(np.frombuffer(finding["codes"], np.uint8))
            labels.append(row["label"])
    size = _BEFORE + _INSIDE + _AFTER
    return train(np.array(codes, np.uint8).reshape(len(codes), size), np.array(labels, np.float32))


def all_spans(text: str | None, net: Network | None) -> list[tuple[str, int, int, float]]:
    return scan([text], net)[0]


def scan(texts: list[str | None], net: Network | None) -> list[list[tuple]]:
    """Spans (kind, start, end, score) of each text; the rules' score is 1."""
    found, codes, places, best = [], [], [], {}
    for row, text in enumerate(texts):
        spans = rule_spans(text)
        found.append([(*span, 1.0) for span in spans])
        if net is None or not text:
            continue
        _, left, free = pieces(text, spans)
        for start, end in left + free:
            for a, b in windows(start, end):
                codes.append(encode(text, a, b))
                places.append((row, start, end))
    for at in range(0, len(codes), 512):
        scores = net.scores(np.array(codes[at : at + 512]))
        for place, score in zip(places[at : at + 512], scores.tolist()):
            best[place] = max(score, best.get(place, 0.0))
    for (row, start, end), score in best.items():
        if score >= net.threshold:
            found[row].append(("network", start, end, score))
    return [sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))) for spans in found]


def find_secrets(df: DataFrame, net: Network | None, text: str = "text", into: str = "secrets") -> DataFrame:
    """``df`` with the spans of each text."""
    spans_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    )

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                spans = scan(part.column(text).to_pylist(), net)
                rows = [[dict(zip(("kind", "start", "end", "score"), s)) for s in row] for row in spans]
                names = [n for n in part.schema.names if n != into]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(rows, spans_type)], [*names, into]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != into)
    return df.mapInArrow(run, f"{fields}{', ' if fields else ''}`{into}` {_SPANS}")


def masked(text: str | None, spans: list[dict]) -> str | None:
    """The text with each stretch of spans replaced by ``MASK``."""
    if not text or not spans:
        return text
    out, at = [], 0
    for span in sorted(spans, key=lambda s: s["start"]):
        if span["start"] >= at:
            out += [text[at : span["start"]], MASK]
        at = max(at, span["end"])
    return "".join(out) + text[at:]


def mask_secrets(
    df: DataFrame, net: Network | None, text: str = "text", size: str | None = None
) -> DataFrame:
    """``df`` with the secrets in its texts masked; same columns.

    A column ``size`` of text lengths follows in the rows that change.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = part.column(text).to_pylist()
                spans = scan(texts, net)
                clean = [
                    masked(t, [{"start": s[1], "end": s[2]} for s in row])
                    for t, row in zip(texts, spans)
                ]
                changed = {text: pa.array(clean, pa.string())}
                if size:
                    sizes = part.column(size)
                    changed[size] = pa.array(
                        [len(c) if row else old for c, row, old in zip(clean, spans, sizes.to_pylist())],
                        sizes.type,
                    )
                columns = [changed.get(n, part.column(n)) for n in part.schema.names]
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return df.mapInArrow(run, df.schema)


def digests(documents: DataFrame) -> DataFrame:
    """Per document: how often each rule matched, and the spans of rules and network."""
    net = fit(documents)
    found = find_secrets(documents.select("doc_id", "text"), net).drop("text")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"] != "network")), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
