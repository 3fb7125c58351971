"""Personal data: plain patterns, and a semi-Markov conditional random field for what is written otherwise.

The field scores whole spans, not single tokens: their shape, checksum, cue words before them and separators, and each
pair of neighbouring segments by their kinds. Its dynamic programme takes the best cutting of a stretch of tokens into
typed spans of bounded length and plain tokens; every range of tokens up to that length is a candidate. It is trained here, on sentences made by rule from fixed seeds, and looks only at stretches around digits,
at-signs and spelt-out separators; elsewhere every token is plain.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import column, per_text, ship

BASE_KINDS = ("email", "ip", "card", "phone")
#: What the field may add, besides further spans of the base kinds.
KINDS = (*BASE_KINDS, "id", "secret")
#: Most tokens in a span, by kind.
LONGEST = {"email": 15, "ip": 15, "card": 11, "phone": 11, "id": 9, "secret": 5}

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The plain patterns, leftmost and without overlap in each kind; by start, then kind as listed."""
    out: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:  # a match starts with the whole run before an at-sign
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0]) if m.end() - m.start() >= 14 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# ------------------------------------------------------------------ the field

TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_|\S")
CUES = {
    "email": {"email", "mail", "e", "write", "contact"},
    "phone": {"call", "phone", "tel", "telephone", "mobile", "fax", "ring", "whatsapp", "cell"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit"},
    "ip": {"ip", "host", "address", "server", "ipv6"},
    "id": {"ssn", "passport", "iban", "id", "license", "licence", "social", "security", "tax", "account"},
    "secret": {"token", "password", "passwd", "pwd", "secret", "key", "apikey", "pin", "bearer"},
}
AT, DOT = {"at", "@"}, {"dot", "."}
SHAPES = [
    re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"),
    re.compile(r"\(?0[0-9]{1,4}\)?[ ./-]?[0-9]{2,4}(?:[ ./-]?[0-9]{2,4}){1,3}"),
    re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?"),
    re.compile(r"(?:[0-9]{4}[ .-]){3}[0-9]{4}|[0-9]{4}[ .-][0-9]{6}[ .-][0-9]{5}"),
    re.compile(r"[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(dot\)|dot) ?[0-9]{1,3}){3}"),
    re.compile(r"(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}"),
    re.compile(r"[\w.+-]+(?: ?(?:\[at\]|\(at\)) ?[\w-]+(?:(?: ?\[dot\] ?| ?\(dot\) ?| dot |\.)[\w-]+)+| at [\w-]+(?: dot [\w-]+)+|@[\w-]+(?:\.[\w-]+)+)", re.I),
    re.compile(r"(?:sk|pk|ghp|xox[bp]|AKIA)[-_]?[A-Za-z0-9_-]{12,}"),
    re.compile(r"[0-9a-f]{32,}"),
    re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]{8,}"),
]
N_FEATURES = len(SHAPES) + 12


def features(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> list[list[int]]:
    """For tokens i to j, the indices of its features under each kind."""
    start, end = tokens[i][0], tokens[j - 1][1]
    span = text[start:end]
    digits = sum("0" <= c <= "9" for c in span)
    common = [k for k, shape in enumerate(SHAPES) if shape.fullmatch(span)]
    k = len(SHAPES)
    if not common:
        common.append(k)
    common.append(k + 1 + min(4, digits // 4))
    if digits >= 13 and luhn("".join(c for c in span if "0" <= c <= "9")):
        common.append(k + 6)
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        common.append(k + 7)
    if not span[-1].isalnum():
        common.append(k + 8)
    if j < len(tokens) and text[tokens[j][0]].isdigit():
        common.append(k + 11)
    before = {text[a:b].lower() for a, b in tokens[max(0, i - 3) : i]}
    out = []
    for kind in KINDS:
        mine = [*common, k + 9] if before & CUES[kind] else list(common)
        out.append([*mine, k + 10])
    return out


@functools.lru_cache(maxsize=1 << 16)
def _able(span: str) -> bool:
    """Some shape fits the span."""
    return any(shape.fullmatch(span) for shape in SHAPES)


def candidates(text: str, tokens: list[tuple[int, int]], taken: np.ndarray | None = None, reach: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Token ranges up to the longest span that hold a trigger, do not cut a word and do not touch what is taken.

    With reach (of the field), ranges without a shape are left out where they could not be chosen whatever is around them.
    """
    out = []
    longest = max(LONGEST.values())
    for i in range(len(tokens)):
        first = text[tokens[i][0]]
        if not (first.isalnum() or first == "("):
            continue
        digits, cued = 0, None
        for j in range(i + 1, min(len(tokens), i + longest) + 1):
            if taken is not None and taken[j - 1]:
                break
            a, b = tokens[j - 1]
            digits += sum("0" <= c <= "9" for c in text[a:b])
            if not text[b - 1].isalnum():
                continue
            span = text[tokens[i][0] : b]
            if reach is not None and not _able(span):
                if cued is None:
                    before = {text[a:b].lower() for a, b in tokens[max(0, i - 3) : i]}
                    cued = [bool(before & CUES[kind]) for kind in KINDS]
                bucket, sum_ = min(4, digits // 4), digits >= 13
                if not any(j - i <= LONGEST[kind] and reach[y, bucket, int(sum_), int(cued[y])] for y, kind in enumerate(KINDS)):
                    continue
            if MARK.search(span):
                out.append((i, j))
    return out


#: What a span must hold to be personal data of some kind.
MARK = re.compile(r"[0-9@]|\b(?:at|dot|AT|DOT)\b")


class Field:
    """weights: score of (kind, feature). pairs: score of neighbouring segments (label before, label); label 0 is a plain
    token, kind y is label y + 1; two plain tokens score nothing.
    """

    def __init__(self) -> None:
        self.weights = np.zeros((len(KINDS), N_FEATURES))
        self.pairs = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def reach(self) -> np.ndarray:
        """Whether a span without a shape could be in a best cutting, by kind, digits (in fours), a checksum that may hold,
        and a cue word before it: with all that it could gain besides, and with the neighbours that suit it best, against
        plain tokens in its place.
        """
        k, w, t = len(SHAPES), self.weights, self.pairs
        gain = np.maximum(w, 0)
        sure = w[:, k] + w[:, k + 10] + gain[:, [k + 7, k + 8, k + 11]].sum(axis=1) + (t[:, 1:] - t[:, :1]).max(axis=0) + (t[1:] - t[:1]).max(axis=1)
        most = sure[:, None, None, None] + w[:, k + 1 : k + 6, None, None] + np.stack([0 * w[:, k + 6], gain[:, k + 6]], axis=1)[:, None, :, None] + np.stack([0 * w[:, k + 9], w[:, k + 9]], axis=1)[:, None, None, :]
        return most >= 0


def span_scores(text: str, tokens: list[tuple[int, int]], spans: list[tuple[int, int]], weights: np.ndarray) -> np.ndarray:
    out = np.empty((len(spans), len(KINDS)))
    for k, (i, j) in enumerate(spans):
        out[k] = [weights[y, f].sum() if j - i <= LONGEST[kind] else -1e9 for y, (kind, f) in enumerate(zip(KINDS, features(text, tokens, i, j), strict=True))]
    return out


def best_cut(n: int, spans: list[tuple[int, int]], scores: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int, int]]:
    """The best cutting of n tokens into spans with a kind and plain tokens, by spans' scores and those of neighbours."""
    ends: dict[int, list[int]] = {}
    for k, (_, j) in enumerate(spans):
        ends.setdefault(j, []).append(k)
    value = np.full((n + 1, len(pairs)), -np.inf)
    value[0, 0] = 0.0
    back: list[list[tuple | None]] = [[None] * len(pairs) for _ in range(n + 1)]
    into: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for j in range(1, n + 1):
        before = value[j - 1] + pairs[:, 0]
        p = int(before.argmax())
        value[j, 0], back[j][0] = before[p], (j - 1, p)
        for k in ends.get(j, ()):
            i = spans[k][0]
            if i not in into:
                m = value[i][:, None] + pairs[:, 1:]
                into[i] = m.max(axis=0), m.argmax(axis=0)
            most, of = into[i]
            total = most + scores[k]
            for y in np.flatnonzero(total > value[j, 1:]):
                value[j, y + 1], back[j][y + 1] = total[y], (i, int(of[y]))
    out, j, y = [], n, int(value[n].argmax())
    while j:
        i, p = back[j][y]
        if y:
            out.append((i, j, y - 1))
        j, y = i, p
    return out[::-1]


def _sum(x: np.ndarray, axis: int | None = None) -> np.ndarray:
    """Logarithm of summed exponentials."""
    top = np.maximum(x.max(axis=axis, keepdims=True), -1e300)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis=axis)


def _marginals(n: int, spans: list[tuple[int, int]], scores: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The field's probability of every (span, kind), and how often it expects every pair of neighbouring labels: by the
    forward and backward sums over all cuttings.
    """
    begin: dict[int, list[int]] = {}
    end: dict[int, list[int]] = {}
    for k, (i, j) in enumerate(spans):
        begin.setdefault(i, []).append(k)
        end.setdefault(j, []).append(k)
    first, last = np.array([i for i, _ in spans], int), np.array([j for _, j in spans], int)
    ahead, into, behind = (np.full((n + 1, len(pairs)), -np.inf) for _ in range(3))
    ahead[0, 0], behind[n] = 0.0, 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        for j in range(n + 1):
            if j:
                ahead[j, 0] = into[j - 1, 0]
                if k := end.get(j):
                    ahead[j, 1:] = _sum(into[first[k], 1:] + scores[k], 0)
            into[j] = _sum(ahead[j][:, None] + pairs, 0)
        for i in range(n - 1, -1, -1):
            follow = [pairs[:, :1] + behind[i + 1, 0]]
            if k := begin.get(i):
                follow += [pairs[:, 1:] + x for x in scores[k] + behind[last[k], 1:]]
            behind[i] = _sum(np.concatenate(follow, axis=1), 1)
        total = _sum(ahead[n])
        p = np.exp(into[first, 1:] + scores + behind[last, 1:] - total) if spans else np.zeros((0, len(pairs) - 1))
        expected = np.zeros_like(pairs)
        expected[:, 0] = np.exp(ahead[:-1] + pairs[:, 0] + behind[1:, :1] - total).sum(axis=0)
        for k, i in enumerate(first):
            expected[:, 1:] += np.exp(ahead[i][:, None] + pairs[:, 1:] + scores[k] + behind[last[k], 1:] - total)
    return p, expected


#: Training: sentences made by rule, passes over them, step and shrinkage. All bounds are fixed.
SENTENCES, PASSES, RATE, DECAY = 360, 12, 0.3, 1e-3


def _made(rng: random.Random) -> tuple[str, str, str]:
    """(text before, span, kind or '' for plain) by rule."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice("abcdefghilmnoprstuvz") for _ in range(rng.randint(3, 8)))

    def card() -> str:
        x = rng.choice("3456") + d(14)
        return x + next(c for c in "0123456789" if luhn(x + c))

    def dotted() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    h = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((32, 40, 64))))
    sep = rng.choice(" -.")
    c, ip = card(), dotted()
    return rng.choice([
        ("mail ", f"{w()} [at] {w()} [dot] {w()[:3]}", "email"), ("", f"{w()}.{w()} (at) {w()}.{w()[:3]}", "email"), ("contact ", f"{w()} at {w()} dot {w()[:3]}", "email"),
        ("call ", f"({d(3)}) {d(3)}-{d(4)}", "phone"), ("", f"{d(3)}{sep}{d(3)}{sep}{d(4)}", "phone"), ("tel ", f"0{d(3)} {d(3)} {d(4)}", "phone"), ("phone ", f"0{d(2)}-{d(4)}-{d(4)}", "phone"),
        ("card ", f"{c[:4]}.{c[4:8]}.{c[8:12]}.{c[12:]}", "card"), ("visa ", f"{c[:4]}.{c[4:8]}.{c[8:12]}.{c[12:]}", "card"),
        ("", ip.replace(".", "[.]"), "ip"), ("server ", ip.replace(".", " dot "), "ip"), ("", ":".join(h[k : k + 4] for k in range(0, 32, 4)), "ip"),
        ("ssn ", f"{d(3)}-{d(2)}-{d(4)}", "id"), ("", f"{d(3)}-{d(2)}-{d(4)}", "id"), ("iban ", f"DE{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}", "id"), ("account ", f"GB{d(2)}ABCD{d(12)}", "id"), ("passport ", f"{rng.choice('ABCX')}{d(8)}", "id"),
        ("token = ", h, "secret"), ("key ", h, "secret"), ("", h, "secret"), ("password ", w() + d(4), "secret"), ("secret: ", f"sk-{h[:24]}", "secret"), ("", f"AKIA{h[:16].upper()}", "secret"),
        ("", d(rng.randint(1, 8)), ""), ("", f"{d(2)}.{d(2)}.{d(4)}", ""), ("", f"{d(1)},{d(3)}.{d(2)}", ""), ("", d(16), ""), ("", f"{d(4)} {d(4)} {d(4)} {d(4)}", ""), ("page ", f"{d(2)}-{d(2)}", ""), ("", f"{d(4)}-{d(2)}-{d(2)}", ""),
        ("", f"{w()} at {w()}", ""), ("", f"{w()} at {w()} {w()}", ""), ("", f"v{d(1)}.{d(1)}.{d(2)}", ""), ("", f"{w()}{d(2)}", ""), ("", f"{d(1)} {d(3)} {d(3)}", ""), ("chapter ", f"0{d(1)}.{d(2)}", ""), ("", f"{w()}{d(6)}", ""), ("", f"0{d(9)}", ""),
    ])


@functools.lru_cache
def trained() -> Field:
    """The field that maximises the conditional likelihood of the made sentences."""
    rng = random.Random(7)
    words = "the of und la de que les was mit on to a note see for this in by".split()
    sentences = []
    for _ in range(SENTENCES):
        text, gold = " ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) + " ", []
        for _ in range(rng.randint(1, 2)):
            before, span, kind = _made(rng)
            text += before
            if kind:
                gold.append((len(text), len(text) + len(span), KINDS.index(kind)))
            text += span + rng.choice([" ", ". ", ", "]) + " ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) + " "
        tokens = [m.span() for m in TOKEN.finditer(text)]
        spans = candidates(text, tokens)
        if not spans:
            continue
        place = {(tokens[i][0], tokens[j - 1][1]): k for k, (i, j) in enumerate(spans)}
        truth, label = np.zeros((len(spans), len(KINDS))), [0] * len(tokens)
        for a, b, y in gold:
            if (a, b) in place:
                k = place[a, b]
                truth[k, y] = 1
                i, j = spans[k]
                label[i:j] = [y + 1] + [-1] * (j - i - 1)  # one segment
        x = np.zeros((len(spans), len(KINDS), N_FEATURES))
        for k, (i, j) in enumerate(spans):
            for y, f in enumerate(features(text, tokens, i, j)):
                x[k, y, f] = 1
        seen = np.zeros((len(KINDS) + 1, len(KINDS) + 1))
        for p, y in itertools.pairwise([0, *(y for y in label if y >= 0)]):
            seen[p, y] += 1
        allowed = np.array([[0.0 if j - i <= LONGEST[kind] else -1e9 for kind in KINDS] for i, j in spans])
        sentences.append((len(tokens), spans, x, truth, seen, allowed))
    field = Field()
    grown, paired = np.full_like(field.weights, 1e-6), np.full_like(field.pairs, 1e-6)
    for _ in range(PASSES):
        for n, spans, x, truth, seen, allowed in sentences:
            p, expected = _marginals(n, spans, np.einsum("kyf,yf->ky", x, field.weights) + allowed, field.pairs)
            slope = np.einsum("ky,kyf->yf", truth - p, x) - DECAY * field.weights
            grown += slope**2
            field.weights += RATE * slope / np.sqrt(grown)
            slope = seen - expected - DECAY * field.pairs
            slope[0, 0] = 0.0
            paired += slope**2
            field.pairs += RATE * slope / np.sqrt(paired)
    return field


#: Where a stretch may hold personal data; characters of a stretch on either side; gap that joins two.
TRIGGER = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]|\b(?:at|AT)\b(?= [\w-]+ (?:dot|DOT)\b)")
AROUND, JOIN = 48, 48


def field_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Spans that the field adds to the base ones, none touching them."""
    stretches: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        if stretches and m.start() - stretches[-1][1] <= JOIN:
            stretches[-1][1] = m.end()
        else:
            stretches.append([m.start(), m.end()])
    out: list[Span] = []
    reach = field.reach()
    edges = np.array([(a, b) for a, b, _ in base], np.int64).reshape(-1, 2)
    done = 0
    for a, b in stretches:
        if b <= done:  # the stretch before grew over it
            continue
        a, b = max(0, a - AROUND), min(len(text), b + AROUND)
        while a and not text[a - 1].isspace():  # never inside a word, however long it is
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        done = b
        part = text[a:b]
        tokens = [m.span() for m in TOKEN.finditer(part)]
        if not tokens:
            continue
        taken = np.zeros(len(tokens), bool)
        if len(edges):
            t = np.array(tokens) + a
            k = np.searchsorted(np.maximum.accumulate(edges[:, 1]), t[:, 0], "right")
            taken = (k < len(edges)) & (edges[np.minimum(k, len(edges) - 1), 0] < t[:, 1])
        spans = candidates(part, tokens, taken, reach)
        if not spans:
            continue
        for i, j, y in best_cut(len(tokens), spans, span_scores(part, tokens, spans, field.weights), field.pairs):
            out.append((a + tokens[i][0], a + tokens[j - 1][1], KINDS[y]))
    kept: list[Span] = []
    for s in sorted(set(out)):
        if not kept or s[0] >= kept[-1][1]:
            kept.append(s)
    return kept


def find(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text; offsets in code points, end exclusive."""
    base = base_spans(text)
    return base, sorted([*base, *field_spans(text, base, field)], key=lambda s: (s[0], KINDS.index(s[2])))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one, named by the first."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of docs: counts of the base kinds, hash of the base spans, all spans, how many were added.

    Null or empty text: zeros, the hash of nothing and no spans. Repeated rows each get a row, a null doc_id stays null,
    texts are read whole, and only doc_id and text are read, whatever other columns are called. A map over the scan.
    """
    field = trained()

    def measure(raw: bytes) -> tuple:
        base, every = find(raw.decode(errors="replace"), field)
        counts = [sum(k == kind for _, _, k in base) for kind in BASE_KINDS]
        return *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every), len(every) - len(base)

    return per_text(docs, measure, SCHEMA)


def mask(docs: DataFrame) -> DataFrame:
    """docs with personal data in `text` replaced by its kind in angle brackets; null texts stay null, no row is added or lost.

    A column n_chars, where docs has one, is set to the new length.
    """
    field = trained()
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def hide(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda x: None if x is None else masked(x, find(x, field)[1]))

    out = docs.withColumn("text", hide(column(docs, "text", "string")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
