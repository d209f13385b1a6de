"""Personal data: base patterns, and a semi-Markov conditional random field over whole spans.

The base finds e-mail addresses, IP addresses, card and phone numbers by fixed patterns, each in
time linear in the text.  The field adds spans that no base span overlaps, and keys, codes and IBANs around base spans (digits
inside a key may look like a card).  It looks at
islands: runs of tokens that have a digit or an @, and the letters inside an IBAN in groups.  Every candidate segment of an island is scored as a
whole (its shape, checksums, the words before it); bounded-entity dynamic programming then
chooses boundaries and types together.  Outside islands nothing can be personal data of
the kinds below, so plain prose costs one scan.  The weights are learned here, by the exact gradient of
the log-likelihood, from examples that :func:`examples` writes; no document is needed.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import blocks, slices

BASE = ("email", "ip", "card", "phone")
#: The field's types; the last three have no base pattern.
KINDS = (*BASE, "id", "iban", "secret")

Span = tuple[int, int, str]  # start, end, kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SEED = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """Matches of the base pattern: from each @ back over the local part, which nothing is read twice for."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end(), "email"
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(last, at + 1))


def addresses(text: str) -> Iterator[Span]:
    """Four parts at a time of each run of dotted numbers."""
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                yield at, end, "ip"
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """All base spans by (start, kind as listed)."""
    if not _SEED.search(text):
        return []
    out = list(emails(text))
    out += addresses(text)
    out += ((m.start(), m.end(), "card") for m in _CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d))
    if "+" in text:
        out += ((m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15)
    return sorted(out, key=lambda s: (s[0], BASE.index(s[2])))


# --- the field ---------------------------------------------------------------------------

#: Most tokens of an entity, those of nine groups with blanks between; a key in one run may have more.
LONGEST = 17
#: Characters of an entity with blanks in it at most, as of its forms none is longer; of an island that is decoded at once, at least, and
#: what is read beyond them.  A window ends at white space, so a key, which has none, lies in one however long it is.
SPACED, WINDOW, OVERLAP = 200, 400, 240

_TOKEN = re.compile(r"[^\W_]+|[^\S]+|[\W_]")
_CUE = re.compile(r"[^\W\d_]+")
_HEX = re.compile(r"[0-9a-fA-F]{24,}")
_RUN = re.compile(r"[A-Za-z0-9_-]+")
_GROUP = re.compile(r"[A-Z]{1,6}[.,;:)]?")
_UNDERWAY = re.compile(r"(?:^|[^\w])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9])*$")
_KEYLIKE = re.compile(r"[A-Za-z0-9_-]{20,}")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_FOUR = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_DATE = re.compile(r"[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4}")
_NUMBER = re.compile(r"[0-9]{1,3}(?:[,.][0-9]{3})*(?:[.,][0-9]+)?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}")
_ID = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_TEL = re.compile(r"(?:\+?[0-9]{1,3}[ .-]?)?\(?[0-9]{2,5}\)?(?:[ .-][0-9]{2,4}){1,4}")
_CARDLIKE = re.compile(r"[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,4})?|[0-9]{12,19}")

#: Words that announce a kind, in the corpus' languages.
CUES = {
    "email": "mail email e-mail correo courriel contact write",
    "ip": "ip host server address addr client",
    "card": "card visa mastercard amex credit karte carte tarjeta",
    "phone": "phone tel telephone call fax mobile cell telefon telefono téléphone teléfono ring",
    "id": "ssn social security passport id tax",
    "iban": "iban account konto cuenta compte bank",
    "secret": "key token secret password api bearer auth credential apikey passwd pwd",
}
_CUE_OF = {w: k for k, ws in CUES.items() for w in ws.split()}


def _mod97(s: str) -> bool:
    own = "".join(str(int(c, 36)) for c in s[4:] + s[:4])
    return int(own) % 97 == 1


def span_features(text: str, start: int, end: int, cue: str | None) -> list[str]:
    """Names of the features that hold of the whole span."""
    s = text[start:end]
    d = _digits(s)
    before, after = text[start - 1 : start], text[end : end + 1]
    out = ["one", f"digits {min(len(d) // 3, 7)}", f"cue {cue}"]
    tests = (
        ("email", _EMAIL.fullmatch(s)),
        ("four", _FOUR.fullmatch(s) and all(int(x) < 256 for x in s.split("."))),
        ("luhn", _CARDLIKE.fullmatch(s) and 12 <= len(d) <= 19 and luhn(d)),
        ("cardlike", _CARDLIKE.fullmatch(s)),
        ("plus", s[0] == "+" and 9 <= len(d) <= 15),
        ("tel", _TEL.fullmatch(s) and 9 <= len(d) <= 15),
        ("id", _ID.fullmatch(s)),
        ("iban", _IBAN.fullmatch(s) and _mod97(s.replace(" ", ""))),
        ("hex", _HEX.fullmatch(s) and d and len(d) < len(s)),
        ("keylike", _KEYLIKE.fullmatch(s) and d and re.search("[A-Z]", s) and re.search("[a-z]", s)),
        ("date", _DATE.fullmatch(s)),
        ("number", _NUMBER.fullmatch(s)),
        ("joined before", before.isalnum() or before in "+@-_." and before),
        ("joined after", after.isalnum() or after in "@-_" and after),
        ("letters", any(c.isalpha() for c in s)),
        ("blank", " " in s),
    )
    return out + [name for name, holds in tests if holds]


def _possible(s: str) -> bool:
    """Whether a span can be an entity at all: enough digits, an address, or a long key."""
    if len(s) > SPACED and _SPACE.search(s) or s[0].isspace() or s[-1].isspace() or not (s[0].isalnum() or s[0] in "+(") or not s[-1].isalnum():
        return False
    if "@" in s:
        return bool(_EMAIL.fullmatch(s))
    n = sum("0" <= c <= "9" for c in s)
    if n >= 7 and not any(c.isalpha() for c in s):
        return True
    return bool(_FOUR.fullmatch(s)) or bool(_IBAN.fullmatch(s)) or n > 0 and bool(_KEYLIKE.fullmatch(s) or _HEX.fullmatch(s))


def candidates(text: str, start: int, end: int) -> tuple[int, list[tuple[int, int, int, int, list[str]]]]:
    """Tokens of the island, and its segments as (first token, token after, start, end, features)."""
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
    words = _CUE.findall(text, max(0, start - 40), start)
    cue = next((_CUE_OF[w.lower()] for w in reversed(words[-4:]) if w.lower() in _CUE_OF), None)
    out, run_end, ends = [], start, [b for _, b in tokens]
    for i, (a, _) in enumerate(tokens):
        first = text[a]
        if " " in text[a - 1 : a] and (m := _CUE.match(text, a)) and m[0].lower() in _CUE_OF and not text[m.end() : m.end() + 1].isalnum():
            cue = _CUE_OF[m[0].lower()]  # a group of letters inside the island
        if not (first.isalnum() or first in "+("):
            continue
        for j in range(i, min(len(tokens), i + LONGEST)):
            b = tokens[j][1]
            if _possible(text[a:b]):
                out.append((i, j + 1, a, b, span_features(text, a, b, cue)))
        if a >= run_end and (m := _RUN.match(text, a, end)):  # the whole of a run of more tokens
            run_end = m.end()
            b = a + len(m[0].rstrip("_-"))
            j = bisect.bisect_left(ends, b)
            if j >= i + LONGEST and j < len(ends) and ends[j] == b and _possible(text[a:b]):
                out.append((i, j + 1, a, b, span_features(text, a, b, cue)))
    return len(tokens), out


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Runs of tokens with a digit or @, and of groups of capitals where an IBAN may be under way."""
    at, n = 0, len(text)
    while True:
        m = _SEED.search(text, at)
        if not m:
            return
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = m.end()
        while end < n:
            stop = _SPACE.search(text, end)
            end = stop.start() if stop else n
            nxt = _SPACE.search(text, end + 1) if end < n else None
            until = nxt.start() if nxt else n
            if end >= n or text[end] not in " \t":
                break
            if not _SEED.search(text, end + 1, until) and not (_GROUP.fullmatch(text, end + 1, until) and _UNDERWAY.search(text[max(start, end - 48) : end])):
                break
            end = until
        yield start, end
        at = end


def decoded(text: str, start: int, end: int, field: Field) -> Iterator[Span]:
    """The field's spans in an island.  A long one is decoded in windows: what starts in the last ``OVERLAP`` characters of
    a window, more than an entity has, is left to the next, which begins there or after the last span."""
    at = start
    while at < end:
        stop, upto = end, end
        if end - at > WINDOW + OVERLAP and (m := _SPACE.search(text, at + WINDOW, end)):
            beyond = _SPACE.search(text, m.start() + OVERLAP, end)
            if beyond:
                upto, stop = m.start(), beyond.start()
        size, segments = candidates(text, at, stop)
        nxt = upto
        for k, y in field.decode(size, segments) if segments else ():
            s, e = segments[k][2], segments[k][3]
            if s < upto:
                yield s, e, KINDS[y]
                nxt = max(nxt, e)
        at = nxt


_SPACE = re.compile(r"\s")


class Field:
    """Weights of features by kind, and of neighbouring kinds (the last: no entity)."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.w = np.zeros((0, len(KINDS)))
        self.t = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def rows(self, feats: list[str]) -> list[int]:
        return [self.number[f] for f in feats if f in self.number]

    def scores(self, feats: list[list[str]]) -> np.ndarray:
        return np.array([self.w[self.rows(f)].sum(axis=0) for f in feats]).reshape(-1, len(KINDS))

    def _lattice(self, n: int, segments: list) -> list[list[tuple[int, int]]]:
        ends: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for k, seg in enumerate(segments):
            ends[seg[1]].append((seg[0], k))
        return ends

    def decode(self, n: int, segments: list) -> list[tuple[int, int]]:
        """(segment, kind) of the best segmentation; tokens outside entities are segments of one token."""
        score, ends, none = self.scores([s[4] for s in segments]), self._lattice(n, segments), len(KINDS)
        value = np.full((n + 1, none + 1), -np.inf)
        value[0, none] = 0.0
        back: dict[tuple[int, int], tuple[int, int, int]] = {}
        for j in range(1, n + 1):
            from_none = value[j - 1] + self.t[:, none]
            value[j, none], back[j, none] = from_none.max(), (j - 1, int(from_none.argmax()), -1)
            for i, k in ends[j]:
                own = (value[i][:, None] + self.t[:, :none]).max(axis=0) + score[k]
                prev = (value[i][:, None] + self.t[:, :none]).argmax(axis=0)
                for y in np.flatnonzero(own > value[j, :none]):
                    value[j, y], back[j, int(y)] = own[y], (i, int(prev[y]), k)
        out, j, y = [], n, int(value[n].argmax())
        while j > 0:
            i, before, k = back[j, y]
            if k >= 0:
                out.append((k, y))
            j, y = i, before
        return out[::-1]

    def gradient(self, n: int, segments: list, gold: dict[int, int]) -> tuple[float, list, np.ndarray]:
        """Log-likelihood of the gold segmentation; expected less observed counts."""
        score, ends, none = self.scores([s[4] for s in segments]), self._lattice(n, segments), len(KINDS)
        lse = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis=axis))
        alpha = np.full((n + 1, none + 1), -1e9)
        alpha[0, none] = 0.0
        for j in range(1, n + 1):
            alpha[j, none] = lse(alpha[j - 1] + self.t[:, none], 0)
            for i, k in ends[j]:
                alpha[j, :none] = np.logaddexp(alpha[j, :none], lse(alpha[i][:, None] + self.t[:, :none], 0) + score[k])
        beta = np.full((n + 1, none + 1), -1e9)
        beta[n] = 0.0
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for k, seg in enumerate(segments):
            starts[seg[0]].append((seg[1], k))
        for i in range(n - 1, -1, -1):
            own = self.t[:, none] + beta[i + 1, none]
            for j, k in starts[i]:
                own = np.logaddexp(own, lse(self.t[:, :none] + score[k] + beta[j, :none], 1))
            beta[i] = own
        z = lse(alpha[n], 0)
        dt = np.zeros_like(self.t)
        seg_p = np.zeros_like(score)
        for i in range(n):
            p = np.exp(alpha[i] + self.t[:, none] + beta[i + 1, none] - z)
            dt[:, none] += p
            for j, k in starts[i]:
                both = np.exp(alpha[i][:, None] + self.t[:, :none] + score[k] + beta[j, :none] - z)
                dt[:, :none] += both
                seg_p[k] += both.sum(axis=0)
        i, y, own = 0, none, 0.0
        at = {segments[k][0]: (segments[k][1], k, kind) for k, kind in gold.items()}
        while i < n:
            j, k, kind = at.get(i, (i + 1, -1, none))
            own += self.t[y, kind] + (score[k, kind] if k >= 0 else 0.0)
            dt[y, kind] -= 1
            if k >= 0:
                seg_p[k, kind] -= 1
            i, y = j, kind
        return own - z, [(self.rows(segments[k][4]), seg_p[k]) for k in range(len(segments))], dt


def examples(n: int, seed: int) -> list[tuple[str, list[Span]]]:
    """Lines with spans of each kind, and with numbers that are none of them."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("abcdefghilmnoprstuv") for _ in range(r.randint(2, 8)))

    def card() -> str:
        body = r.choice("3456") + digits(r.choice([13, 14, 14, 14]))
        full = next(body + c for c in "0123456789" if luhn(body + c))
        return full if r.random() < 0.5 or len(full) != 16 else r.choice(" -").join(full[i : i + 4] for i in range(0, 16, 4))

    def iban() -> str:
        body = r.choice(["DE", "FR", "ES", "GB", "NL", "NO", "IE", "MT", "RU"])
        own = "".join(r.choice("ABCDEFGHIKLMNORSTUVW") for _ in range(4)) if body in ("GB", "NL", "IE", "MT") else ""
        own += digits(r.randint(25, 29) if body == "RU" else r.randint(12, 20))
        full = next(f"{body}{k:02d}{own}" for k in range(100) if _mod97(f"{body}{k:02d}{own}"))
        return full if r.random() < 0.5 else " ".join(full[i : i + 4] for i in range(0, len(full), 4))

    def parted() -> str:
        letters, mark = "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789", r.choice("_-")
        groups = ["".join(r.choice(letters) for _ in range(r.randint(4, 40))) for _ in range(r.randint(2, 7))]
        return mark.join([*groups, "aB3" + "".join(r.choice(letters) for _ in range(20))])

    make = {
        "email": lambda: f"{word()}{r.choice(['', '.', '_', '+'])}{digits(r.randint(1, 3))}@{word()}{r.choice(['', digits(1)])}.{r.choice(['com', 'org', 'co.uk', 'de'])}",
        "ip": lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: r.choice([f"+{r.randint(1, 99)} {digits(3)} {digits(3)} {digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"0{digits(2)} {digits(4)} {digits(4)}"]),
        "id": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "iban": iban,
        "secret": lambda: r.choice(["".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 40, 64]))), "".join(r.choice("abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(r.randint(24, 48))), parted()]),
    }
    other = [
        lambda: f"{r.randint(1900, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}",
        lambda: f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1900, 2030)}",
        lambda: f"{r.randint(1, 999)},{digits(3)},{digits(3)}",
        lambda: f"{digits(r.randint(7, 9))}",
        lambda: f"{r.randint(1, 99)}.{r.randint(1, 20)}.{r.randint(0, 20)}",
        lambda: f"{r.randint(1, 99999)}.{digits(r.randint(2, 9))}",
        lambda: f"{digits(4)}-{digits(4)}",
        lambda: f"{digits(2)}:{digits(2)}:{digits(2)}",
        lambda: " ".join(digits(r.randint(1, 4)) for _ in range(r.randint(3, 7))),
        lambda: next(d for _ in iter(int, 1) if not luhn(d := digits(r.choice([13, 16])))),
        lambda: f"ISBN {digits(3)}-{digits(1)}-{digits(3)}-{digits(5)}-{digits(1)}",
    ]
    out = []
    for _ in range(n):
        text, spans = " ".join(word() for _ in range(r.randint(1, 4))) + " ", []
        for _ in range(r.choice([1, 1, 1, 2])):
            if r.random() < 0.45:
                text += r.choice(other)()
            else:
                kind = r.choice(KINDS)
                if r.random() < 0.4:
                    text += r.choice(CUES[kind].split()) + r.choice([" ", ": ", " = "])
                s = make[kind]()
                spans.append((len(text), len(text) + len(s), kind))
                text += s
            text += r.choice([" ", ", ", ". ", f" {word()} ", f" {word()} "])
        out.append((text + word(), spans))
    return out


@functools.lru_cache(maxsize=2)
def trained(n: int = 400, rounds: int = 8, seed: int = 11) -> Field:
    """The field, learned from ``n`` examples: the same at every call."""
    field = Field()
    data = []
    for text, spans in examples(n, seed):
        for a, b in islands(text):
            size, segments = candidates(text, a, b)
            at = {(s, e): KINDS.index(kind) for s, e, kind in spans}
            gold = {k: at[seg[2], seg[3]] for k, seg in enumerate(segments) if (seg[2], seg[3]) in at}
            if segments:
                data.append((size, segments, gold))
    for f in sorted({f for _, segs, _ in data for s in segs for f in s[4]}):
        field.number[f] = len(field.number)
    field.w = np.zeros((len(field.number), len(KINDS)))
    gw, gt = np.full_like(field.w, 1e-6), np.full_like(field.t, 1e-6)
    order = list(range(len(data)))
    r = random.Random(seed)
    for _ in range(rounds):
        r.shuffle(order)
        for i in order:
            _, parts, dt = field.gradient(*data[i])
            dw = 1e-4 * field.w
            for rows, p in parts:
                np.add.at(dw, rows, p[None, :])
            gw += dw**2
            gt += dt**2
            field.w -= 0.5 * dw / np.sqrt(gw)
            field.t -= 0.2 * dt / np.sqrt(gt)
    return field


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, base spans and those the field adds), each by (start, kind)."""
    base = base_spans(text)
    if not base and not _SEED.search(text):
        return [], []
    taken = sorted(base)
    firsts, reach = [s[0] for s in taken], list(itertools.accumulate((s[1] for s in taken), max))
    more = []
    for a, b in islands(text):
        for s, e, kind in decoded(text, a, b, field):
            near = taken[bisect.bisect_right(reach, s) : bisect.bisect_left(firsts, e)]
            if not any(s < z and (kind in BASE or x < s or z > e) for x, z, _ in near):
                more.append((s, e, kind))
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def find_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of ``docs``.

    A null or empty text has no span (the digest is that of the empty string).  Repeated rows give repeated rows; an empty table gives
    no rows; other columns are not read.  Spans are code points, end exclusive.  A map: nothing is shuffled.
    """
    held = docs.sparkSession.sparkContext.broadcast(field or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in blocks(batch, "text"):
                rows = [all_spans(t, held.value) for t in texts]
                counts = [pa.array([sum(s[2] == kind for s in base) for base, _ in rows], pa.int64()) for kind in BASE]
                sha = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(texts)).cast(pa.int64()), *counts, sha, pa.array([joined(x) for _, x in rows], pa.string())],
                    names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by its first kind in brackets."""
    out, at, end = [], 0, -1
    for s, e, kind in sorted(spans, key=lambda x: (x[0], -x[1])):
        if s >= end:
            out += [text[at:s], f"[{kind.upper()}]"]
        end = at = max(end, e)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` masked, and ``n_chars`` (where there is one) of the new text.

    A null text stays null; every row stays, with its other columns as they are.
    """
    held = docs.sparkSession.sparkContext.broadcast(field or trained())
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices([batch.column(at)]):
                own = batch.slice(first, n)
                texts = [t and masked(t, all_spans(t, held.value)[1]) for t in own.column(at).to_pylist()]
                yield own.set_column(at, "text", pa.array(texts, pa.string()))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
