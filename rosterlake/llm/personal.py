"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF on top.

The network is trained in numpy on windows of the corpus that the patterns have labelled. It reads
overlapping windows; what the windows decode is reconciled over the whole text.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rosterlake.llm.common import fresh

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, and from one window's start to the next.
WINDOW, STRIDE = 128, 64
#: Windows that the network is trained on, at most: half with labelled spans, half without.
SAMPLE_WINDOWS = 3000
HIDDEN, STEPS, BATCH, RATE = 16, 400, 64, 0.02
#: What each character of a span that the network adds must be worth, as a probability.
LEAST_PROBABILITY = 0.9
#: Windows decoded at a time.
DECODED = 512
#: Spans of any kind hold one of these, so that windows without them have none.
TELLING = "[0-9@]"

_TELLING = re.compile(TELLING)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SEVERAL_AT = re.compile(r"[^@]*@[^@]*")


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10 == 0


def is_valid(kind: str, found: str) -> bool:
    """What a match must fulfil beyond its pattern."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in found.split("."))
    if kind == "email":
        return True
    digits = _NOT_DIGIT.sub("", found)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the pattern for addresses, found from their @, in time that grows with the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points: by kind, the leftmost matches that do not overlap, if valid."""
    found = [("email", a, b) for a, b in _emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in pattern.finditer(text):
            if is_valid(kind, m.group()):
                found.append((kind, m.start(), m.end()))
    return found


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a telling character."""
    starts, last = [], max(0, len(text) - WINDOW + STRIDE - 1) // STRIDE
    for m in _TELLING.finditer(text):
        low = max(0, (m.start() - WINDOW) // STRIDE + 1)
        for k in range(max(low, starts[-1] + 1 if starts else 0), min(last, m.start() // STRIDE) + 1):
            starts.append(k)
    return [k * STRIDE for k in starts]


def codes(text: str) -> np.ndarray:
    """Character classes: 1 to 95 printable ASCII with letters in lower case, 96 other white space, 97 the rest; 0 is padding."""
    own = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return _CLASSES[np.minimum(own, 128)]


_CLASSES = np.full(129, 97, np.uint8)
_CLASSES[0x20:0x7F] = np.arange(1, 96)
_CLASSES[0x41:0x5B] = _CLASSES[0x61:0x7B]
_CLASSES[[*range(0x09, 0x0E)]] = 96
N_CLASSES, N_TAGS = 98, 1 + 2 * len(KINDS)


def padded(part: np.ndarray) -> np.ndarray:
    return np.concatenate([part, np.zeros(WINDOW - len(part), part.dtype)])


def tags(spans: list[tuple[str, int, int]], start: int) -> np.ndarray:
    """Tags of a window: 0 outside, 2k + 1 the first character of kind k, 2k + 2 the others."""
    own = np.zeros(WINDOW, np.uint8)
    for kind, a, b in reversed(spans):  # of spans that overlap, the kind listed first
        k, low, high = KINDS.index(kind), max(a - start, 0), min(b - start, WINDOW)
        if low < high:
            own[low:high] = 2 * k + 2
            if a >= start:
                own[low] = 2 * k + 1
    return own


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Tagger:
    """A bidirectional LSTM over characters, whose outputs are the emissions of a linear-chain CRF."""

    def __init__(self, seed: int = 12, hidden: int = HIDDEN, weights: dict[str, np.ndarray] | None = None) -> None:
        if weights:
            self.weights, self.hidden = weights, len(weights["own_f"])
            return
        rng, h = np.random.default_rng(seed), hidden
        small = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
        self.hidden = h
        self.weights = {"out": small(2 * h, N_TAGS), "bias": np.zeros(N_TAGS, np.float32), "moves": small(N_TAGS, N_TAGS)}
        for way in ("f", "b"):
            self.weights |= {f"in_{way}": small(N_CLASSES, 4 * h), f"own_{way}": small(h, 4 * h)}
            self.weights[f"in_{way}"][:, h : 2 * h] += 1  # gates forget little at first

    def _pass(self, x: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """States (time, batch, hidden) of one direction; gates are kept for the way back."""
        w_in, w_own, h = self.weights[f"in_{way}"], self.weights[f"own_{way}"], self.hidden
        steps, n = x.shape
        out, kept = np.zeros((steps, n, h), np.float32), []
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = w_in[x[t]] + state @ w_own
            gates, fresh_cell = _sigmoid(z[:, : 3 * h]), np.tanh(z[:, 3 * h :])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            before, earlier = cell, state
            cell = f * cell + i * fresh_cell
            squashed = np.tanh(cell)
            state = o * squashed
            out[t] = state
            if keep:
                kept.append((t, i, f, o, fresh_cell, before, squashed, earlier))
        return out, kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(time, batch, tags) for classes (time, batch)."""
        both = np.concatenate([self._pass(x, way, False)[0] for way in ("f", "b")], 2)
        return both @ self.weights["out"] + self.weights["bias"]

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities of tags, expected moves between tags) under the CRF."""
        moves = np.exp(self.weights["moves"].astype(np.float64))
        steps, n, k = scores.shape
        emit = np.exp((scores - scores.max(2, keepdims=True)).astype(np.float64))
        ahead, behind = np.empty((steps, n, k)), np.empty((steps, n, k))
        ahead[0] = emit[0] / emit[0].sum(1, keepdims=True)
        for t in range(1, steps):
            own = (ahead[t - 1] @ moves) * emit[t]
            ahead[t] = own / own.sum(1, keepdims=True)
        behind[-1] = 1
        expected = np.zeros((k, k))
        for t in range(steps - 2, -1, -1):
            after = emit[t + 1] * behind[t + 1]
            own = after @ moves.T
            pairs = (ahead[t] * own).sum(1, keepdims=True)
            expected += (ahead[t] / pairs).T @ after * moves
            behind[t] = own / own.sum(1, keepdims=True)
        each = ahead * behind
        return each / each.sum(2, keepdims=True), expected

    def best(self, scores: np.ndarray) -> np.ndarray:
        """The likeliest tags (time, batch), by Viterbi."""
        moves, back, total = self.weights["moves"], [], scores[0]
        for t in range(1, len(scores)):
            each = total[:, :, None] + moves
            back.append(each.argmax(1))
            total = each.max(1) + scores[t]
        path = [total.argmax(1)]
        for step in reversed(back):
            path.append(step[np.arange(len(step)), path[-1]])
        return np.array(path[::-1])

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-likelihood of tags y (time, batch) given classes x."""
        w, h, n = self.weights, self.hidden, x.shape[1]
        passes = {way: self._pass(x, way, True) for way in ("f", "b")}
        both = np.concatenate([passes["f"][0], passes["b"][0]], 2)
        likely, expected = self.marginals(both @ w["out"] + w["bias"])
        slope = likely.astype(np.float32)
        np.put_along_axis(slope, y[:, :, None], np.take_along_axis(slope, y[:, :, None], 2) - 1, 2)
        slope /= n
        seen = np.zeros_like(expected)
        np.add.at(seen, (y[:-1].ravel(), y[1:].ravel()), 1)
        grads = {
            "out": np.tensordot(both, slope, ((0, 1), (0, 1))),
            "bias": slope.sum((0, 1)),
            "moves": ((expected - seen) / n).astype(np.float32),
        }
        down = slope @ w["out"].T
        for at, way in enumerate(("f", "b")):
            own, g_in, g_own = w[f"own_{way}"], np.zeros_like(w[f"in_{way}"]), np.zeros_like(w[f"own_{way}"])
            d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for t, i, f, o, fresh_cell, before, squashed, earlier in reversed(passes[way][1]):
                ds = down[t][:, at * h : (at + 1) * h] + d_state
                dc = d_cell + ds * o * (1 - squashed**2)
                dz = np.concatenate(
                    [dc * fresh_cell * i * (1 - i), dc * before * f * (1 - f), ds * squashed * o * (1 - o), dc * i * (1 - fresh_cell**2)], 1
                )
                np.add.at(g_in, x[t], dz)
                g_own += earlier.T @ dz
                d_state, d_cell = dz @ own.T, dc * f
            grads |= {f"in_{way}": g_in, f"own_{way}": g_own}
        return grads

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 12) -> Tagger:
        """Fits windows (rows of classes and tags) by Adam, with gradients cut at norm 5."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        orders = [rng.permutation(len(x)) for _ in range(-(-steps * batch // len(x)))]
        order = np.concatenate(orders)
        for step in range(1, steps + 1):
            own = order[(step - 1) * batch : step * batch]
            grads = self.gradients(np.ascontiguousarray(x[own].T), np.ascontiguousarray(y[own].T).astype(np.int64))
            norm = float(np.sqrt(sum((g.astype(np.float64) ** 2).sum() for g in grads.values())))
            pace = rate * (1 - 0.9 * step / steps)
            for name, g in grads.items():
                g = g * min(1, 5 / max(norm, 1e-9))
                mean[name] = 0.9 * mean[name] + 0.1 * g
                square[name] = 0.99 * square[name] + 0.01 * g * g
                m, s = mean[name] / (1 - 0.9**step), square[name] / (1 - 0.99**step)
                self.weights[name] = (self.weights[name] - pace * m / (np.sqrt(s) + 1e-6)).astype(np.float32)
        return self

    def spans(self, x: np.ndarray) -> Iterator[tuple[int, str, int, int, float]]:
        """(row, kind, start, end, least probability of its characters) of what windows (rows) hold."""
        scores = self.emissions(np.ascontiguousarray(x.T))
        path, likely = self.best(scores), self.marginals(scores)[0]
        kinds = (path + 1) // 2
        begins = (kinds > 0) & ((path % 2 == 1) | (np.concatenate([np.zeros_like(kinds[:1]), kinds[:-1]]) != kinds))
        for row in np.flatnonzero(begins.any(0)).tolist():
            for start in np.flatnonzero(begins[:, row]).tolist():
                k, end = kinds[start, row], start + 1
                while end < len(path) and kinds[end, row] == k and not begins[end, row]:
                    end += 1
                sure = likely[start:end, row, 2 * k - 1 : 2 * k + 1].sum(1).min()
                yield row, KINDS[k - 1], start, end, float(sure)


def chosen(spans: list[tuple[int, int, float, str]]) -> list[tuple[int, int, float, str]]:
    """Of spans (start, end, weight, kind) those without overlap that weigh most together."""
    spans = sorted(set(spans), key=lambda s: (s[1], s[0], s[3]))
    ends, best = [s[1] for s in spans], [(0.0, -1, -1)]
    for n, (start, _, weight, _) in enumerate(spans):
        at = bisect_right(ends, start, 0, n)
        with_it = best[at][0] + weight
        best.append((with_it, at, n) if with_it > best[-1][0] else (best[-1][0], n, -1))
    out, at = [], len(spans)
    while at > 0:
        _, before, n = best[at]
        if n >= 0:
            out.append(spans[n])
        at = before
    return out[::-1]


def added_spans(model: Tagger, texts: list[tuple[str, list[tuple[str, int, int]]]], least: float = LEAST_PROBABILITY) -> list[list[tuple[str, int, int]]]:
    """What the network adds to each text's pattern spans: valid spans that overlap none of them."""
    found: list[list[tuple[int, int, float, str]]] = [[] for _ in texts]
    waiting: list[tuple[int, int, np.ndarray]] = []

    def decode() -> None:
        if not waiting:
            return
        for row, kind, a, b, sure in model.spans(np.array([w[2] for w in waiting])):
            text, start, _ = waiting[row]
            whole, size = texts[text][0], b - a
            cut = (a == 0 and start > 0) or (b == WINDOW and start + WINDOW < len(whole))
            if sure >= least and not cut:  # a neighbouring window holds all of a span cut off here
                found[text].append((start + a, start + b, sure * size, kind))
        waiting.clear()

    for k, (text, _) in enumerate(texts):
        own = codes(text)
        for start in window_starts(text):
            waiting.append((k, start, padded(own[start : start + WINDOW])))
            if len(waiting) == DECODED:
                decode()
    decode()
    results = []
    for (text, base), own in zip(texts, found, strict=True):
        taken = union([(a, b) for _, a, b in base])
        starts = [a for a, _ in taken]
        free = []
        for a, b, weight, kind in own:
            at = bisect_left(starts, b) - 1
            if (at < 0 or taken[at][1] <= a) and looks_like(kind, text[a:b]):
                free.append((a, b, weight, kind))
        results.append([(kind, a, b) for a, b, _, kind in chosen(free)])
    return results


def looks_like(kind: str, found: str) -> bool:
    """What a span that the network adds must hold: the parts of its kind, and no more digits than it has."""
    if kind == "email":
        local, _, domain = found.partition("@")
        return bool(local and domain) and not re.search(r"\s", found)
    if kind == "ip":
        parts = re.findall("[0-9]+", found)
        return len(parts) == 4 and is_valid("ip", ".".join(parts))
    return is_valid(kind, found) and found[0] in "+(0123456789" and found[-1] in "0123456789"


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans' union as spans that do not overlap, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    """(labelled, window, tags): at most `most` windows, half with spans, those with the smallest hashes.

    Windows are counted first, so that few more than are wanted leave the tasks.
    """
    telling = rows.where(F.col("text").rlike(TELLING)).select("text")

    def windows(bounds: dict[bool, float] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out, counts = [], {True: 0, False: 0}
                for text in batch["text"].to_pylist():
                    spans, own, starts = pattern_spans(text), None, window_starts(text)
                    for start in starts:
                        y = tags(spans, start)
                        labelled = bool(y.any())
                        counts[labelled] += 1
                        if bounds is None:
                            continue
                        part = text[start : start + WINDOW]
                        place = int.from_bytes(hashlib.blake2b(part.encode("utf-8", "replace"), digest_size=6).digest(), "big")
                        if place < bounds[labelled] * (1 << 48):
                            own = codes(text) if own is None else own
                            out.append((labelled, place, padded(own[start : start + WINDOW]).tobytes(), y.tobytes()))
                if bounds is None:
                    out = [(k, n, None, None) for k, n in counts.items() if n]
                kinds = [pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
                columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["labelled", "place", "x", "y"])

        return telling.mapInArrow(run, "labelled boolean, place long, x binary, y binary")

    counts = dict(windows(None).groupBy("labelled").agg(F.sum("place")).collect())
    half = most // 2
    bounds = {k: min(1.0, 2 * half / max(1, counts.get(k) or 0)) for k in (True, False)}
    # equal windows are one example
    found = windows(bounds).groupBy("labelled", "place").agg(F.first("x").alias("x"), F.first("y").alias("y"))
    parts = [found.where(F.col("labelled") == k).orderBy("place").limit(half) for k in (True, False)]
    return parts[0].unionByName(parts[1])


def trained(rows: DataFrame, most: int = SAMPLE_WINDOWS) -> Tagger | None:
    """The network, fitted in one task to at most `most` windows of the texts; None where no window has a span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        if not any(labelled for labelled, *_ in rows):
            return
        x, y = (np.array([np.frombuffer(r[i], np.uint8) for r in rows]) for i in (2, 3))
        model = Tagger().train(x, y)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model.weights)]})

    found = _sampled(rows, most).repartition(1).mapInArrow(run, "model binary").collect()
    if not found:
        return None
    return Tagger(weights=pickle.loads(found[0].model))


_DDL = "struct<base: array<struct<kind: string, start: long, end: long>>, added: array<struct<kind: string, start: long, end: long>>, redacted: string>"


def personal_data(docs: DataFrame, text_col: str = "text", redact: bool = True, model: Tagger | None = None) -> tuple[DataFrame, str]:
    """The rows with one more column, whose name is returned: a struct of the personal data in a text.

    `base` are the patterns' spans by kind, then start; `added` those that the network finds beside
    them, in the same order: sure by `LEAST_PROBABILITY`, valid for their kind, and apart from all
    base spans. Spans count code points, ends are exclusive. `redacted` is the text with every span
    replaced by its kind in angle brackets, null unless wanted. The network is trained on the given
    texts unless `model` is handed in. Null and empty texts have no spans; repeated rows have the
    same result each; an empty table gives no rows; other columns stay.
    """
    name = fresh(docs, "personal")
    schema = StructType([*docs.schema, *StructType.fromDDL(f"{name} {_DDL}")])
    kind, at = to_arrow_schema(StructType(schema.fields[-1:])).field(0).type, docs.columns.index(text_col)
    model = model or trained(docs.select(F.col(text_col).alias("text")))
    weights = model and model.weights

    def found(texts: list[str | None]) -> list[dict]:
        telling = [k for k, text in enumerate(texts) if text and _TELLING.search(text)]
        base = {k: pattern_spans(texts[k]) for k in telling}
        own = [(texts[k], base[k]) for k in telling]
        more = added_spans(Tagger(weights=weights), own) if weights else [[] for _ in own]
        added = dict(zip(telling, more, strict=True))
        order = lambda s: (KINDS.index(s[0]), s[1])
        named = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in sorted(spans, key=order)]
        return [
            {
                "base": named(base.get(k, [])),
                "added": named(added.get(k, [])),
                "redacted": redacted(text, base.get(k, []) + added.get(k, [])) if redact else None,
            }
            for k, text in enumerate(texts)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(found(batch.column(at).to_pylist()), kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=schema.names)

    return docs.mapInArrow(run, schema), name


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str:
    """The text with its spans replaced; of spans that overlap, the one that begins first counts."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join(out) + (text or "")[at:]
