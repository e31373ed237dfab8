"""Personal data: patterns, and a character BiLSTM with CRF transitions (operator 10).

Base spans come from four fixed patterns. The model is trained in numpy on windows of a
bounded sample whose characters carry the base spans as labels, and reads every character
of every text: texts are laid end to end (a mark between them), cut into overlapping
windows, and decoded in batches by Viterbi. A character's tag is that of the window in which
it lies farthest from an edge; equal neighbouring tags then form spans over the whole text,
however many windows they cross. A model span is kept if it touches no base span and reads
as data of its kind: digits that pass the check sum, numbers in range, and so on.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, decode, table, text_list, texts

KINDS = ("email", "ip", "card", "phone")
TAGS = len(KINDS) + 1  # 0 is outside
HIDDEN = 6
CODES = 256
WINDOW, MARGIN = 512, 32
LANES = 2048  # windows decoded side by side
SAMPLE_ROWS = 2_000  # texts to take training windows from, at most
SAMPLE_BYTES = 8 << 20
TRAIN_WINDOW, TRAIN_WINDOWS, STEPS = 72, 4_000, 300

# Fixed patterns. Look-behinds only skip starts inside a run that its first start settled.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = 2 * v - 9 if v > 4 else 2 * v
        total += v
    return total % 10 == 0


def valid_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in re.findall(r"[0-9]+", s))


def valid_card(s: str) -> bool:
    d = "".join(DIGITS.findall(s))
    return 16 <= len(d) <= 19 and luhn(d)


def valid_phone(s: str) -> bool:
    return 8 <= len(DIGITS.findall(s)) <= 15


def emails(text: str):
    """Leftmost matches, found from their @ so that long runs cost no more than their length."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind, by start, in code points, end exclusive."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    if "@" in text:
        out[0] = list(emails(text))
    if DIGITS.search(text):
        out[1] = [m.span() for m in IP.finditer(text) if valid_ip(m.group())]
        out[2] = [m.span() for m in CARD.finditer(text) if valid_card(m.group())]
        if "+" in text:
            out[3] = [m.span() for m in PHONE.finditer(text) if valid_phone(m.group())]
    return out


def span_text(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans) for a, b in own)


def plausible(kind: int, s: str) -> bool:
    """Whether a model span reads as data of its kind."""
    if kind == 0:
        local, _, domain = s.partition("@")
        return bool(local) and "." in domain.strip(".") and not re.search(r"\s", s)
    if kind == 1:
        return len(re.findall(r"[0-9]+", s)) == 4 and valid_ip(s)
    return valid_card(s) if kind == 2 else valid_phone(s) and s[0] in "+(0"


def codes(text: str) -> np.ndarray:
    """One byte per code point: Latin-1 as it is, anything else as one shared code."""
    return np.frombuffer(text.encode("latin-1", "replace"), np.uint8)


class Tagger:
    """BiLSTM-CRF over character codes. Character embeddings are folded into the gates."""

    NAMES = ("x", "u", "out", "bias", "trans")

    def __init__(self, hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.x = 0.3 * rng.standard_normal((2, 4 * hidden, CODES))
        self.x[:, hidden:2 * hidden] += 1.0  # forget gates start open
        self.u = rng.standard_normal((2, 4 * hidden, hidden)) / np.sqrt(hidden) * 0.5
        self.out = 0.3 * rng.standard_normal((TAGS, 2 * hidden))
        self.bias = np.zeros(TAGS)
        self.bias[0] = 1.0
        self.trans = np.zeros((TAGS, TAGS))  # from, to
        # a span is entered from outside and left to outside
        self.forbidden = np.array([[a != b and a > 0 and b > 0 for b in range(TAGS)] for a in range(TAGS)])

    def scales(self) -> np.ndarray:
        """Gates as tanh of scaled inputs: sigmoid(z) = (1 + tanh(z / 2)) / 2 for three of four."""
        s = np.full(4 * self.h, 0.5)
        s[3 * self.h:] = 1.0
        return s[:, None]

    # --- training: one batch of windows, codes (T, B) and tags (T, B) ---------------

    def lstm(self, codes_tb: np.ndarray, d: int):
        h, (steps, lanes) = self.h, codes_tb.shape
        scale, hs, cs, gates = self.scales(), np.zeros((steps + 1, h, lanes)), np.zeros((steps + 1, h, lanes)), []
        for t in range(steps):
            a = np.tanh((self.x[d][:, codes_tb[t]] + self.u[d] @ hs[t]) * scale)
            a[:3 * h] = 0.5 + 0.5 * a[:3 * h]
            gates.append(a)
            cs[t + 1] = a[h:2 * h] * cs[t] + a[:h] * a[3 * h:]
            hs[t + 1] = a[2 * h:3 * h] * np.tanh(cs[t + 1])
        return hs, cs, gates

    def lstm_back(self, codes_tb, d, hs, cs, gates, g_h):
        h, steps = self.h, len(codes_tb)
        g_u, dz_all = np.zeros_like(self.u[d]), []
        dh, dc = np.zeros_like(hs[0]), np.zeros_like(cs[0])
        for t in range(steps - 1, -1, -1):
            i, f, o, g = (gates[t][k * h:(k + 1) * h] for k in range(4))
            dh = dh + g_h[t]
            tc = np.tanh(cs[t + 1])
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * cs[t] * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)])
            g_u += dz @ hs[t].T
            dz_all.append(dz)
            dh, dc = self.u[d].T @ dz, dc * f
        dz = np.stack(dz_all[::-1], axis=1).reshape(4 * h, -1)
        flat = codes_tb.ravel()
        return np.stack([np.bincount(flat, r, CODES) for r in dz]), g_u

    def loss(self, codes_tb: np.ndarray, tags: np.ndarray):
        """Negative log-likelihood per character, and the gradients."""
        steps, lanes = codes_tb.shape
        n = steps * lanes
        fwd, bwd = self.lstm(codes_tb, 0), self.lstm(codes_tb[::-1], 1)
        both = np.concatenate([fwd[0][1:], bwd[0][1:][::-1]], axis=1)  # (T, 2H, B)
        e = self.out @ both + self.bias[:, None]
        tr = np.where(self.forbidden, -1e4, self.trans)

        def lse(z, axis):
            m = z.max(axis=axis, keepdims=True)
            return np.squeeze(m, axis) + np.log(np.exp(z - m).sum(axis=axis))

        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0]
        for t in range(1, steps):
            a[t] = lse(a[t - 1][:, None] + tr[:, :, None], 0) + e[t]
        for t in range(steps - 2, -1, -1):
            b[t] = lse((b[t + 1] + e[t + 1])[None] + tr[:, :, None], 1)
        z = lse(a[-1], 0)
        lane = np.arange(lanes)
        gold = e[np.arange(steps)[:, None], tags, lane].sum() + tr[tags[:-1], tags[1:]].sum()
        g_e = np.exp(a + b - z)
        g_e[np.arange(steps)[:, None], tags, lane] -= 1
        g_tr = np.zeros_like(tr)
        for t in range(1, steps):
            g_tr += np.exp(a[t - 1][:, None] + tr[:, :, None] + (b[t] + e[t])[None] - z).sum(axis=2)
        np.add.at(g_tr, (tags[:-1].ravel(), tags[1:].ravel()), -1)
        g_tr[self.forbidden] = 0
        g_both = self.out.T @ g_e
        x0, u0 = self.lstm_back(codes_tb, 0, *fwd, g_both[:, :self.h])
        x1, u1 = self.lstm_back(codes_tb[::-1], 1, *bwd, g_both[::-1, self.h:])
        grads = {"x": np.stack([x0, x1]), "u": np.stack([u0, u1]), "out": np.einsum("tkb,thb->kh", g_e, both),
                 "bias": g_e.sum(axis=(0, 2)), "trans": g_tr}
        return (z.sum() - gold) / n, {k: g / n for k, g in grads.items()}

    def fit(self, windows: np.ndarray, tags: np.ndarray, steps: int = STEPS, batch: int = 96, rate: float = 0.04,
            seed: int = 2) -> "Tagger":
        """Adam, with a rate that falls to a tenth, on random batches of (N, T) windows."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(getattr(self, k)) for k in self.NAMES}
        v = {k: np.zeros_like(getattr(self, k)) for k in self.NAMES}
        for t in range(1, (steps if len(windows) else 0) + 1):
            part = rng.integers(0, len(windows), batch)
            _, grads = self.loss(windows[part].T.astype(np.intp), tags[part].T.astype(np.intp))
            norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
            now = rate * 0.1 ** (t / steps)
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / max(norm, 1e-12))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                setattr(self, k, getattr(self, k) - now * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8))
        return self

    # --- decoding: lanes of windows side by side, single precision ------------------

    def decode(self, codes_tb: np.ndarray) -> np.ndarray:
        """Viterbi tags (T, B) of windows (T, B)."""
        h, (steps, lanes) = self.h, codes_tb.shape
        scale = self.scales()
        x, u = (self.x * scale).astype(np.float32), (self.u * scale).astype(np.float32)
        codes_tb = codes_tb.astype(np.intp)
        hs = np.empty((steps, 2, h, lanes), np.float32)
        gate, step = np.empty((2, 4 * h, lanes), np.float32), np.empty((2, 4 * h, lanes), np.float32)
        c, now, tmp = (np.zeros((2, h, lanes), np.float32) for _ in range(3))
        for t in range(steps):
            np.take(x[0], codes_tb[t], axis=1, out=gate[0], mode="clip")
            np.take(x[1], codes_tb[steps - 1 - t], axis=1, out=gate[1], mode="clip")
            np.matmul(u, now, out=step)
            gate += step
            np.tanh(gate, out=gate)
            s = gate[:, :3 * h]
            s *= 0.5
            s += 0.5
            c *= gate[:, h:2 * h]
            np.multiply(gate[:, :h], gate[:, 3 * h:], out=tmp)
            c += tmp
            np.tanh(c, out=tmp)
            np.multiply(gate[:, 2 * h:3 * h], tmp, out=now)
            hs[t, 0], hs[steps - 1 - t, 1] = now[0], now[1]
        e = self.out.astype(np.float32) @ hs.reshape(steps, 2 * h, lanes)
        e += self.bias.astype(np.float32)[:, None]
        tr = self.trans.astype(np.float32)
        leave, enter, stay = tr[1:, 0][:, None], tr[0, 1:][:, None], np.diag(tr)[1:][:, None]
        out_score, in_score = e[0, 0].copy(), e[0, 1:].copy()
        left = np.zeros((steps, lanes), np.uint8)  # outside here: the tag before
        stayed = np.zeros((steps, TAGS - 1, lanes), bool)  # inside here: inside before
        for t in range(1, steps):
            frm = in_score + leave
            best = frm.max(axis=0)
            base = out_score + tr[0, 0]
            left[t] = np.where(best > base, frm.argmax(axis=0) + 1, 0)
            keep, new = in_score + stay, out_score + enter
            np.greater_equal(keep, new, out=stayed[t])
            in_score = np.maximum(keep, new) + e[t, 1:]
            out_score = np.maximum(base, best) + e[t, 0]
        tags = np.empty((steps, lanes), np.uint8)
        last = np.concatenate([out_score[None], in_score]).argmax(axis=0).astype(np.uint8)
        lane = np.arange(lanes)
        for t in range(steps - 1, -1, -1):
            tags[t] = last
            inside = stayed[t][np.maximum(last, 1) - 1, lane]
            last = np.where(last == 0, left[t], np.where(inside, last, 0)).astype(np.uint8)
        return tags

    def tag(self, stream: np.ndarray) -> np.ndarray:
        """Tags of a whole stream of codes from overlapping windows: each window settles its
        middle, and the first and last also their outer edge."""
        n, stride = len(stream), WINDOW - 2 * MARGIN
        count = max(1, -(-max(n - 2 * MARGIN, 1) // stride))
        padded = np.zeros((count - 1) * stride + WINDOW, np.uint8)
        padded[:n] = stream
        view = np.lib.stride_tricks.as_strided(padded, (count, WINDOW), (stride, 1))
        out = np.zeros(len(padded), np.uint8)
        for lo in range(0, count, LANES):
            got = self.decode(np.ascontiguousarray(view[lo:lo + LANES].T)).T
            for k in range(len(got)):
                a = 0 if lo + k == 0 else MARGIN
                b = WINDOW if lo + k == count - 1 else WINDOW - MARGIN
                s = (lo + k) * stride
                out[s + a:s + b] = got[k, a:b]
        return out[:n]

    def spans(self, batch: list[str]) -> list[list[tuple[int, int, int]]]:
        """(kind, start, end) of each text, from one stream of all of them."""
        parts, starts, at = [], [], 0
        mark = np.zeros(1, np.uint8)
        for t in batch:
            starts.append(at)
            parts += [codes(t), mark]
            at += len(t) + 1
        out: list[list[tuple[int, int, int]]] = [[] for _ in batch]
        if not batch:
            return out
        stream = np.concatenate(parts)
        tags = np.where(stream == 0, 0, self.tag(stream))
        edge = np.flatnonzero(np.diff(np.concatenate([[0], tags, [0]])))
        starts_a = np.array(starts)
        for a, b in zip(edge[:-1], edge[1:]):
            if tags[a]:
                d = int(np.searchsorted(starts_a, a, side="right")) - 1
                out[d].append((int(tags[a]) - 1, int(a - starts[d]), int(b - starts[d])))
        return out


def training_windows(sample: list[str], limit: int = TRAIN_WINDOWS, size: int = TRAIN_WINDOW, seed: int = 4):
    """(N, size) codes and tags: half of the windows around labelled spans, half anywhere
    near digits, which no pattern takes for data."""
    rng = np.random.default_rng(seed)
    xs, ys, per_kind = [], [], [0] * len(KINDS)
    for text in sample:
        code = np.concatenate([np.zeros(size, np.uint8), codes(text), np.zeros(size, np.uint8)])
        tag = np.zeros(len(code), np.uint8)
        centres = []
        for k, own in reversed(list(enumerate(base_spans(text)))):
            for a, b in own:
                tag[a + size:b + size] = k + 1
                if per_kind[k] < limit // 8:
                    per_kind[k] += 1
                    centres.append((a + b) // 2 + size)
        loose = np.flatnonzero((code >= 48) & (code <= 57) & (tag == 0))
        if len(loose):
            centres += rng.choice(loose, 2).tolist()
        centres += rng.integers(size, max(len(code) - size, size + 1), 1).tolist()
        for c in centres:
            lo = int(np.clip(c - rng.integers(size // 4, 3 * size // 4), 0, len(code) - size))
            xs.append(code[lo:lo + size])
            ys.append(tag[lo:lo + size])
    keep = rng.permutation(len(xs))[:limit]
    empty = np.zeros((0, size), np.uint8)
    return (np.stack([xs[k] for k in keep]), np.stack([ys[k] for k in keep])) if len(keep) else (empty, empty)


def fit_tagger(docs: DataFrame, max_rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Tagger:
    """Train on windows of at most ``max_rows`` whole texts that hold a digit or an @."""
    some = docs.where(F.col("text").rlike("[0-9@]")).select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(1).alias("label"))
    sample = [decode(t) for t, _ in bounded_sample(docs, some, max_rows, max_bytes)]
    return Tagger().fit(*training_windows(sample))


def find_spans(batch: list[str], tagger: Tagger | None):
    """Per text: base spans by kind, and all spans by kind (base, then the model's merged in)."""
    found = tagger.spans(batch) if tagger else [[] for _ in batch]
    for text, more in zip(batch, found):
        base = base_spans(text)
        both = [list(s) for s in base]
        taken = sorted(s for own in base for s in own)
        for kind, a, b in more:
            while a < b and text[a].isspace():
                a += 1
            while a < b and text[b - 1].isspace():
                b -= 1
            if a < b and not any(x < b and a < y for x, y in taken) and plausible(kind, text[a:b]):
                both[kind].append((a, b))
        yield base, [sorted(s) for s in both]


def personal_data(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row: counts and
    digest of the base spans, and all spans as text, ``kind:start:end`` joined by commas.

    One pass over whole texts, no shuffle. Null and empty texts have no spans; repeated rows
    and null ids give one row each. Without a tagger (or one trained on nothing) only base
    spans are found.
    """

    def run(batches):
        for b in batches:
            ids, raw = b.column("doc_id").to_pylist(), text_list(b.column("text"))
            rows = []
            for lo in range(0, len(raw), 512):
                for base, both in find_spans([decode(x) for x in raw[lo:lo + 512]], tagger):
                    rows.append((*map(len, base), hashlib.sha256(span_text(base).encode()).hexdigest(), span_text(both)))
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return texts(docs).mapInArrow(run, SCHEMA)


def redact_text(text: str, spans: list[list[tuple[int, int]]]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; of spans that
    overlap, the union is replaced under the first one's kind."""
    flat = sorted((a, b, k) for k, own in enumerate(spans) for a, b in own)
    out, end = [], 0
    for a, b, k in flat:
        if a >= end:
            out += [text[end:a], f"<{KINDS[k]}>"]
        end = max(end, b)
    return "".join(out) + text[end:]


def redact(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """All rows and columns of ``docs``, with personal data in the text replaced and n_chars,
    where there is such a column, set to the new length. Texts without any stay as they are."""
    has_length = "n_chars" in docs.columns

    def run(batches):
        for b in batches:
            raw, out = b.column("text").cast(pa.binary()).to_pylist(), b.column("text").to_pylist()
            n = b.column("n_chars").to_pylist() if has_length else None
            for lo in range(0, len(raw), 512):
                part = [decode(x or b"") for x in raw[lo:lo + 512]]
                for k, (text, (_, spans)) in enumerate(zip(part, find_spans(part, tagger)), lo):
                    if any(spans):
                        out[k] = redact_text(text, spans)
                        if has_length:
                            n[k] = len(out[k])
            b = b.set_column(b.schema.get_field_index("text"), "text", pa.array(out, b.column("text").type))
            if has_length:
                b = b.set_column(b.schema.get_field_index("n_chars"), "n_chars", pa.array(n, b.column("n_chars").type))
            yield b

    return docs.mapInArrow(run, docs.schema)


def op10_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return personal_data(docs, fit_tagger(docs))
