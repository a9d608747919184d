"""Toxicity scores by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel compares whole texts.  A text is the sum of its units, which are its
words (and runs of three or more one-letter words, as in ``b a d``), each as
often as it occurs, over the root of their number; long units are cut into
overlapping windows.  The kernel of two units sums over all common subsequences
of three letters, within ``SPAN`` positions, the product of their weights
``DECAY ** gaps``, and is normalized by the units' own kernel values.  Letters of
all scripts are distinct; other ASCII characters only count as gaps, so inserted
characters weaken a match but do not destroy it.  Common digit and symbol
stand-ins count as their letters.  Subsequences of ASCII letters have a weight
each, the others share ``1 << 20`` by a hash.

A support vector machine (squared hinge) is fitted to the texts in the space that
the Nystroem method spans with ``LANDMARKS`` landmark units: of each text's unit
most typical of toxic texts, those that explain the most of the others.  As
features there are linear in a unit's subsequence weights, the fitted machine is
one weight per subsequence, and a unit is scored without looking at landmarks
again.  Copies of the toxic texts' typical units with inserted characters are
learned as well.  A text's evidence is the sum of its units' values over the root
of their number and its ``TOP`` highest values (a unit's value is its highest
window's); a logistic calibration, fitted to texts that the machine of another
fold has not seen, makes a score of it.

Training reads ``SAMPLE`` labelled texts per class at most, of ``SAMPLE_CHARS``
characters at most each, chosen by a hash of their id: that bounds the one task
that fits them.  Scoring reads every whole text.

Nulls and empty texts have no units and get the score of an unknown word, a low
one.  Labels that are null, and documents without a label, are not learned from;
of several labels of a document the highest counts.  Without labels of both
classes every score is the share of toxic labels, or 0.  Repeated rows each get
a row, and equal texts get equal scores.  An empty table gives no rows.  Other columns
have no influence, but documents must not have one named ``__toxicity``.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm.tables import table
from loglens.llm.text import U, Words, chunks, mix

SAMPLE = 1500
SAMPLE_CHARS = 5000
LANDMARKS = 500
DECAY = 0.7
SPAN = 6
WINDOW, STRIDE = 16, 8
THRESHOLD = 0.3
TOP = 3                   # highest units of a text that count by themselves
FOLDS = 4
COST = 300.0
BATCH_BYTES = 1 << 20     # text bytes scored at a time
KNOWN = 400_000           # units whose scores a task remembers
ASCII_CODES = 1 << 15     # triples of ASCII classes have a code each, the others share the rest by a hash
CODES = ASCII_CODES + (1 << 20)

#: ASCII classes: letters 1-26, stand-ins as their letters, other digits 27, gaps 0.  Other characters are 32 + their code point.
EDGE = 31                 # before a unit's first character and after its last
CLASS = np.zeros(128, np.int32)
CLASS[ord("a"):ord("z") + 1] = CLASS[ord("A"):ord("Z") + 1] = np.arange(1, 27)
CLASS[ord("0"):ord("9") + 1] = 27
for _a, _b in zip("013457@$", "oieastas"):
    CLASS[ord(_a)] = CLASS[ord(_b)]
GAPS = [(i, j) for i in range(1, SPAN) for j in range(1, SPAN - i)]


#: Lower case of the characters that have one of their own.
FOLD = np.arange(1 << 17, dtype=np.int32)
for _i in range(128, 1 << 17):
    if not 0xD800 <= _i < 0xE000 and len(_low := chr(_i).lower()) == 1:
        FOLD[_i] = ord(_low)


def _points(raw: np.ndarray) -> np.ndarray:
    """The code points of UTF-8 bytes, letters in lower case."""
    head = np.flatnonzero(raw & 0xC0 != 0x80)
    lead = raw[head].astype(np.int32)
    out = np.where(lead < 0x80, lead, np.where(lead < 0xE0, lead & 0x1F, np.where(lead < 0xF0, lead & 0x0F, lead & 0x07)))
    for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
        more = np.flatnonzero(lead >= least)
        out[more] = out[more] << 6 | raw[np.minimum(head[more] + k, len(raw) - 1)] & 0x3F
    return np.where(out < len(FOLD), FOLD[np.minimum(out, len(FOLD) - 1)], out)


def _symbols(points: np.ndarray) -> np.ndarray:
    return np.where(points < 128, CLASS[np.minimum(points, 127)], points.astype(np.int32) + 32)


class Units:
    """The units of the rows of a text column: spans of characters, a hash and a row each."""

    def __init__(self, column):
        w = Words(column)
        kept = w.raw & 0xC0 != 0x80  # the first byte of each character
        self.raw, self.rows = _points(w.raw), len(w)
        place = np.concatenate([[0], np.cumsum(kept)])
        row = np.repeat(np.arange(len(w)), w.counts)
        letter = (w.end - w.start == 1) & (CLASS[w.raw[w.start] & 127] > 0) if len(w.start) else np.zeros(0, bool)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], letter.astype(np.int8), [0]])))
        # a run ends with its row
        first, last = edge[::2], edge[1::2]
        cut = np.unique(np.concatenate([first, w.first[:-1][(w.first[:-1] < len(letter))]])) if len(first) else first
        cut = cut[letter[cut]] if len(cut) else cut
        stop = np.minimum(last[np.searchsorted(last, cut, "right")] if len(cut) else cut, w.first[1:][row[cut]] if len(cut) else cut)
        some = stop - cut >= 3
        cut, stop = cut[some], stop[some]
        run_hash = np.array([mix(np.add.reduce(w.hash[a:b] * (np.arange(b - a, dtype=U) * U(2) + U(3)), keepdims=True))[0] for a, b in zip(cut, stop)], U)
        self.start = place[np.concatenate([w.start, w.start[cut]])]
        self.end = place[np.concatenate([w.end, w.end[stop - 1]]) if len(cut) else w.end]
        self.hash = np.concatenate([w.hash, run_hash])
        self.row = np.concatenate([row, row[cut]])


def _cells(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class matrix of all windows, windows per span); the edges of a span are characters as well."""
    size = end - start + 2
    many = np.maximum(1, -(-(size - STRIDE) // STRIDE))
    k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    begin, stop = np.repeat(start, many), np.repeat(end, many)
    grid = (begin - 1 + k * STRIDE)[:, None] + np.arange(WINDOW)[None, :]
    cells = _symbols(raw[np.clip(grid, 0, len(raw) - 1)]) if len(raw) else np.zeros(grid.shape, np.int32)
    cells = np.where((grid < begin[:, None]) | (grid == stop[:, None]), EDGE, cells)
    return np.where(grid <= stop[:, None], cells, 0), many


def _subsequences(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, weights) per window; code 0 has weight 0."""
    codes, weights = [], []
    wide = np.flatnonzero((cells > EDGE).any(axis=1))  # windows with characters outside ASCII
    x = cells[wide].astype(np.uint32)
    for i, j in GAPS:
        a, b, c = cells[:, :WINDOW - i - j], cells[:, i:WINDOW - j], cells[:, i + j:]
        code = np.where((a > 0) & (b > 0) & (c > 0), a << 10 | b << 5 | c, 0)
        if len(wide):
            a, b, c = x[:, :WINDOW - i - j], x[:, i:WINDOW - j], x[:, i + j:]
            h = ((a * np.uint32(0x9E3779B1) + b) * np.uint32(0x85EBCA6B) + c) * np.uint32(0xC2B2AE35)
            hashed = ASCII_CODES + ((h ^ h >> 15) * np.uint32(0x27D4EB2F) >> 12).astype(np.int32)
            code[wide] = np.where((a | b | c) < 32, code[wide], np.where((a > 0) & (b > 0) & (c > 0), hashed, 0))
        codes.append(code)
        weights.append(np.full(code.shape[1], DECAY ** (i + j - 2), np.float32))
    return np.concatenate(codes, axis=1), np.concatenate(weights)


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The square root of each window's own kernel value; equal subsequences of a window add up first."""
    order = np.argsort(codes, axis=1)
    c = np.take_along_axis(codes, order, 1)
    total = np.cumsum(weights[order].astype(np.float64), axis=1)
    last = np.ones(c.shape, bool)
    last[:, :-1] = c[:, 1:] != c[:, :-1]
    upto = np.where(last, total, 0)
    before = np.maximum.accumulate(np.pad(upto[:, :-1], ((0, 0), (1, 0))), axis=1)
    part = np.where(last & (c > 0), upto - before, 0)
    return np.sqrt((part * part).sum(axis=1))


def _values(cells: np.ndarray, table_: np.ndarray) -> np.ndarray:
    """Normalized sums of a weight per subsequence, per window."""
    out = np.empty(len(cells), np.float64)
    for i in range(0, len(cells), 4096):
        codes, weights = _subsequences(cells[i:i + 4096])
        norm = _norms(codes, weights)
        out[i:i + 4096] = (table_[codes] * weights).sum(axis=1) / np.where(norm > 0, norm, 1)
    return out


def _unit_values(raw, start, end, table_) -> np.ndarray:
    """Each span's highest window value."""
    if not len(start):
        return np.empty(0)
    out = np.empty(len(start))
    step = 1 << 16
    for i in range(0, len(start), step):
        cells, many = _cells(raw, start[i:i + step], end[i:i + step])
        out[i:i + step] = np.maximum.reduceat(_values(cells, table_), np.cumsum(many) - many)
    return out


def _dense(cells: np.ndarray) -> np.ndarray:
    """Normalized subsequence vectors of a few windows."""
    codes, weights = _subsequences(cells)
    out = np.zeros((len(cells), CODES), np.float32)
    np.add.at(out, (np.repeat(np.arange(len(cells)), codes.shape[1]), codes.ravel()), np.tile(weights, len(cells)))
    out[:, 0] = 0
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def _compact(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(normalized subsequence vectors of a few windows over the codes they have, each code's place there; 0 is none)."""
    codes, weights = _subsequences(cells)
    known = np.unique(np.append(codes, 0))
    place = np.zeros(CODES, np.int32)
    place[known] = np.arange(len(known))
    out = np.zeros((len(cells), len(known)), np.float32)
    np.add.at(out, (np.repeat(np.arange(len(cells)), codes.shape[1]), place[codes].ravel()), np.tile(weights, len(cells)))
    out[:, 0] = 0
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    out /= np.where(norm > 0, norm, 1)
    return out, place


def _kernel(cells: np.ndarray, phi: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Normalized kernel values of windows with the landmarks, whose vectors are the columns of ``phi``."""
    codes, weights = _subsequences(cells)
    norm = _norms(codes, weights)
    return np.einsum("nkm,k->nm", phi[place[codes]], weights) / np.where(norm > 0, norm, 1)[:, None]


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float) -> tuple[np.ndarray, float]:
    """A squared-hinge linear machine by Newton steps; y is -1 or 1."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        active = y * (x @ w) < 1
        a, s = x[active], c * weight[active]
        new = np.linalg.solve(ridge + a.T @ (a * s[:, None]), a.T @ (s * y[active]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """(slopes, none below 0, offset) of a calibration of weighted rows with smoothed targets."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    used = np.ones(x.shape[1], bool)
    while True:
        a = np.hstack([x[:, used], np.ones((len(x), 1))])
        ridge = np.diag([1e-3] * used.sum() + [1e-6])
        w = np.zeros(a.shape[1])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            g = a.T @ (weight * (p - t)) + ridge @ w
            step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge, g)
            step *= min(1, 5 / max(np.abs(step).max(), 1e-12))
            w = w - step
            if np.abs(step).max() < 1e-9:
                break
        if (w[:-1] >= 0).all():
            out = np.zeros(x.shape[1])
            out[used] = w[:-1]
            return out, float(w[-1])
        used[np.flatnonzero(used)[w[:-1].argmin()]] = False


def _inserted(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Class matrix of the units with characters inserted: gaps between all letters, a doubled and a foreign letter."""
    out = []
    for a, b in zip(start.tolist(), end.tolist()):
        x = _symbols(raw[a:min(b, a + WINDOW)]).tolist()
        mid = len(x) // 2
        gapped = [v for c in x for v in (c, 0)][:-1]
        ways = [[EDGE, *y, EDGE] for y in (gapped, x[:mid] + x[mid:mid + 1] + x[mid:], x[:mid] + [24] + x[mid:])]
        out += [y[:WINDOW] + [0] * (WINDOW - len(y)) for y in ways]
    return np.array(out, np.int32).reshape(-1, WINDOW)


def _evidence(value: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per row, from its units' values: their sum over the root of their number, and the TOP highest ones (0 for missing ones)."""
    n = np.bincount(row, minlength=rows)
    out = np.zeros((rows, 1 + TOP))
    out[:, 0] = np.bincount(row, weights=value, minlength=rows) / np.sqrt(np.maximum(n, 1))
    order = np.lexsort((-value, row))
    first = np.cumsum(n) - n
    for k in range(TOP):
        has = n > k
        out[has, 1 + k] = value[order[first[has] + k]]
    return out


def _spread(k: np.ndarray, many: np.ndarray, most: int) -> list[int]:
    """Up to ``most`` of the units of kernel matrix ``k``, each the one that explains most of what those before it leave."""
    rest, out = k.astype(np.float64), []
    for _ in range(min(most, len(k))):
        own = np.diag(rest)
        gain = np.where(own > 1e-2, (many[:, None] * rest * rest).sum(axis=0) / np.maximum(own, 1e-2), -1)
        j = int(gain.argmax())
        if gain[j] <= 0:
            break
        out.append(j)
        rest = rest - np.outer(rest[:, j], rest[j]) / own[j]
    return out


def fit(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, c: float = COST, totals: tuple[int, int] | None = None) -> dict:
    """The model of labelled texts: a weight per subsequence and a calibration."""
    y = np.array(labels, int)
    if not len(y) or y.min() == y.max():
        return {"table": np.zeros(CODES, np.float32), "mix": np.zeros(1 + TOP), "shift": 30.0 if len(y) and y.min() else -30.0}
    u = Units(pa.array(texts, pa.string()))
    _, first, back = np.unique(u.hash, return_index=True, return_inverse=True)
    m = len(first)
    pairs, times = np.unique(u.row * m + back, return_counts=True)
    prow, punit = pairs // m, pairs % m
    holds = [np.bincount(punit[y[prow] == k], minlength=m) for k in (0, 1)]
    cells, many = _cells(u.raw, u.start[first], u.end[first])
    begin, unit_of = np.cumsum(many) - many, np.repeat(np.arange(m), many)
    seen = np.zeros((2, CODES))
    step = 4096
    for i in range(0, len(cells), step):
        codes, _ = _subsequences(cells[i:i + step])
        for k in (0, 1):
            seen[k] += np.bincount(codes.ravel(), weights=np.repeat(holds[k][unit_of[i:i + step]], codes.shape[1]), minlength=CODES)
    seen[:, 0] = 0
    # the lower end of an interval of the log odds, so that subsequences of one or two texts do not lead
    rate = np.log((seen[1] + 0.5) / (seen[1].sum() + 1)) - np.log((seen[0] + 0.5) / (seen[0].sum() + 1))
    odds = rate - 1.5 * np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
    odds[0] = -9
    typical = np.empty(len(cells))
    for i in range(0, len(cells), step):
        codes, _ = _subsequences(cells[i:i + step])
        typical[i:i + step] = np.partition(odds[codes], codes.shape[1] - 4, axis=1)[:, -4:].mean(axis=1)
    score = np.maximum.reduceat(typical, begin)
    at = np.array([x + int(np.argmax(typical[x:x + k])) for x, k in zip(begin.tolist(), many.tolist())])
    order = np.lexsort((-score[punit], prow))
    lead = np.unique(prow[order], return_index=True)
    best = [punit[order[lead[1][y[lead[0]] == k]]] for k in (0, 1)]
    picked = []
    for k, share in ((1, 2 * landmarks // 3), (0, landmarks // 3)):
        units, n = np.unique(best[k], return_counts=True)
        gram = np.empty((len(units), len(units)))
        for i in range(0, len(units), 128):
            part, place = _compact(cells[at[units[i:i + 128]]])
            part = np.ascontiguousarray(part.T)
            for j in range(0, len(units), 256):
                gram[j:j + 256, i:i + 128] = _kernel(cells[at[units[j:j + 256]]], part, place)
        picked += units[_spread(gram, n, share)].tolist()
    phi, place = _compact(cells[at[np.unique(picked)]])
    value, vector = np.linalg.eigh((phi @ phi.T).astype(np.float64))
    good = value > 1e-3
    project = vector[:, good] / np.sqrt(value[good])
    across = np.ascontiguousarray(phi.T)
    # texts as sums of their units, and these as means of their windows
    size = np.bincount(prow, weights=times, minlength=len(y))
    by = np.argsort(punit, kind="stable")
    z = np.zeros((len(y), good.sum()))
    for i in range(0, m, 2048):
        lo, hi = begin[i], begin[i + 2048] if i + 2048 < m else len(cells)
        own = np.concatenate([_kernel(cells[x:min(x + 256, hi)], across, place) for x in range(lo, hi, 256)]) @ project
        own = np.add.reduceat(own, begin[i:i + 2048] - lo) / many[i:i + 2048, None]
        a, b = np.searchsorted(punit[by], [i, i + len(own)])
        for q in range(a, b, 65536):
            p = by[q:min(b, q + 65536)]
            p = p[np.argsort(prow[p], kind="stable")]
            r, f = np.unique(prow[p], return_index=True)
            z[r] += np.add.reduceat(own[punit[p] - i] * times[p][:, None], f)
    z /= np.sqrt(np.maximum(size, 1))[:, None]
    # the typical units of toxic texts that lead no clean one, with inserted characters, as texts of one unit
    lead_of = np.full(len(y), -1)
    lead_of[prow[order[lead[1]]]] = punit[order[lead[1]]]
    owner = np.flatnonzero((y == 1) & (lead_of >= 0) & ~np.isin(lead_of, best[0]))
    owner = owner[np.unique(lead_of[owner], return_index=True)[1]]
    shown = _inserted(u.raw, u.start[first][lead_of[owner]], u.end[first][lead_of[owner]])
    extra = np.concatenate([_kernel(shown[i:i + 256], across, place) for i in range(0, len(shown), 256)]) @ project if len(shown) else np.empty((0, good.sum()))
    source = np.concatenate([np.arange(len(y)), np.repeat(owner, 3)])
    z = np.concatenate([z, extra])
    weight = np.concatenate([50.0 / np.bincount(y)[y], np.full(len(extra), 50.0 / max(1, len(extra)))])
    sign = np.concatenate([2.0 * y - 1, np.ones(len(extra))])

    def machine(mine: np.ndarray) -> np.ndarray:
        """A weight per subsequence, learned from some texts and their copies."""
        rows = np.flatnonzero(mine[source])
        w, _ = _svm(z[rows], sign[rows], weight[rows] * len(y) / mine.sum(), c)
        out = np.zeros(CODES, np.float32)
        out[place > 0] = (phi.T @ (project @ w))[place[place > 0]]
        return out

    def evidence(table_: np.ndarray, mine: np.ndarray) -> np.ndarray:
        """The evidence of some texts (that of the others is not whole)."""
        used = np.zeros(m, bool)
        used[punit[mine[prow]]] = True
        v = np.zeros(len(cells))
        v[used[unit_of]] = _values(cells[used[unit_of]], table_)
        return _evidence(np.maximum.reduceat(v, begin)[back], u.row, len(y))

    fold = np.zeros(len(y), int)
    for k in (0, 1):
        fold[y == k] = np.arange((y == k).sum()) % FOLDS
    x = np.zeros((len(y), 1 + TOP))
    for k in range(FOLDS):
        mine, rest = fold == k, fold != k
        if mine.any() and rest.any() and y[rest].min() < y[rest].max():
            x[mine] = evidence(machine(rest), mine)[mine]
    table_ = machine(np.ones(len(y), bool))
    share = np.array([(y == 0).sum(), (y == 1).sum()] if totals is None else totals, float) / np.bincount(y)
    mix_, shift = _logistic(x, y, share[y])
    return {"table": table_, "mix": mix_, "shift": shift}


class Scorer:
    """Scores rows by a model; remembers the values of units."""

    def __init__(self, model: dict):
        self.model = model
        self.hash, self.value = np.empty(0, U), np.empty(0)

    def rows(self, column) -> np.ndarray:
        u, m = Units(column), self.model
        seen = np.zeros((u.rows, 1 + TOP))
        if len(u.hash):
            distinct, first, back = np.unique(u.hash, return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(self.hash, distinct), max(0, len(self.hash) - 1))
            known = self.hash[at] == distinct if len(self.hash) else np.zeros(len(distinct), bool)
            value = np.empty(len(distinct))
            value[known] = self.value[at[known]]
            new = first[~known]
            value[~known] = _unit_values(u.raw, u.start[new], u.end[new], m["table"])
            if len(self.hash) > KNOWN:
                self.hash, self.value = distinct, value
            else:
                h = np.concatenate([self.hash, distinct[~known]])
                order = np.argsort(h)
                self.hash, self.value = h[order], np.concatenate([self.value, value[~known]])[order]
            seen = _evidence(value[back], u.row, u.rows)
        return 1 / (1 + np.exp(-np.clip(seen @ m["mix"] + m["shift"], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> dict:
    """Fit on at most ``sample`` texts per class of docs (doc_id, text) with labels (doc_id, toxic)."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    short = docs.where(F.char_length("text").between(1, sample_chars)).select("doc_id", F.xxhash64("text").alias("key"))
    able = short.join(known, "doc_id")  # ids and hashes only: no text is shuffled
    counted = {r["toxic"]: r["n"] for r in known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    take = [able.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id", "key").limit(sample) for k in (0, 1)]
    picked = take[0].unionByName(take[1]).dropDuplicates(["doc_id", "key"])  # 2 * sample rows at most: may be broadcast
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).join(F.broadcast(picked), ["doc_id", "key"])
    totals = (counted.get(0, 0), counted.get(1, 0))

    def run(batches):
        rows = sorted({row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic")))})
        model = fit([r[1] for r in rows], [r[2] for r in rows], totals=totals)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # The sample is bounded: one task fits it, the driver only gets the model.
    made = texts.select("doc_id", "text", "toxic").dropDuplicates(["doc_id", "text"]).coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else fit([], [])


def with_scores(docs: DataFrame, model: dict, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """All rows and columns with the score as ``out_col double`` (which replaces a column of that name)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != out_col]
    types = dict(docs.dtypes)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in chunks(batches, text_col, BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scorer.rows(batch.column(text_col)))], [*keep, out_col])

    return docs.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{out_col}` double"]))


def held_out(doc_id: str) -> Column:
    """Rows that training does not learn from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def q_op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs.where(~held_out("doc_id")), table(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = with_scores(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents scored below the threshold, with all their columns."""
    return with_scores(docs, model, text_col, "__toxicity").where(F.col("__toxicity") < threshold).drop("__toxicity")
