"""Personal data by a semi-Markov conditional random field over base patterns.

Base patterns for e-mail, IP, card and phone are found first and stay. Around digits, @ signs and
spelled-out ats, text is cut into tokens, and a semi-Markov model labels whole segments: features of
a candidate as a whole (its shape, digits, separators, check digit, the words before it, whether a
base pattern matches it) score each label, and a dynamic program over segments of bounded length
chooses boundaries and types jointly. What it labels beside the base spans, overlapping none, is
added: phone numbers without a country code, spelled-out e-mails, cards and addresses in other
punctuation. A segment's shape is a feature and leaves none out.

A run of letters, digits, dots and marks that holds a letter is one token, however long, and windows end
at white space or where no token is, so neither bound cuts a name short; a spelled-out address found
goes on over any more `[dot] word` that follow, so the bound on a segment's tokens does not either.
Beside letters, only segments of up to MOST_DIGITS digits are candidates, as longer ones are no kind here.

Weights maximise the conditional likelihood of sentences generated here; training is deterministic
and takes a few seconds once on the driver.

Cases: a null text counts as empty; an empty text has no span; texts of any length are searched
whole; repeated rows are searched each; an empty table gives an empty result; columns other than id
and text are not read.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, small_batches, strings

KINDS = ("email", "ip", "card", "phone")
#: The weight of each feature under each kind.
Weights = dict[str, dict[str, float]]
#: Tokens of a segment at most, and characters of context around a sign, at least.
MOST_TOKENS, AROUND = 32, 48

TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]|[\[(] ?(?:at|dot) ?[\])]", re.I)
#: More labels of a spelled-out address.
MORE = re.compile(r"(?: ?[\[(] ?dot ?[\])] ?|\.)[A-Za-z0-9-]+", re.I)
DIGIT = re.compile(r"[0-9]")
#: A run with a letter in it, digits, or a single character.
TOKEN = re.compile(r"(?:[0-9%+_-]+(?:\.[0-9%+_-]+)*\.?)?[^\W\d_][\w%+-]*(?:\.[\w%+-]+)*|[0-9]+|\s|[^\w\s]|_|\w")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, in time that grows with the text: the run before each @, and what follows."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > free and LOCAL.match(text, a - 1):
            a -= 1
        if a < at and (m := TAIL.match(text, at)):
            free = m.end()
            out.append((a, free))
            at = text.find("@", free)
            continue
        free = max(free, at + 1)  # no match can hold this sign
        at = text.find("@", at + 1)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the base patterns by kind, in code points."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = _emails(text)
    if DIGIT.search(text):
        found["ip"] = [m.span() for m in IP.finditer(text) if all(map(_small, m.group().split(".")))]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
        if "+" in text:
            found["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return found


#: Words that announce a kind.
CUES = {
    "email": ("mail", "email", "e-mail", "write", "contact", "reach"),
    "ip": ("ip", "host", "address", "server", "from", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "charged"),
    "phone": ("call", "phone", "tel", "mobile", "fax", "cell", "ring"),
}
#: Words that announce a number of another sort.
OTHERS = ("version", "order", "invoice", "isbn", "serial", "part", "build", "release", "item", "page", "account", "total")
SPELLED = re.compile(r"[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)* ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]+(?:(?: ?[\[(] ?dot ?[\])] ?|\.)[A-Za-z0-9-]+)+", re.I)
LOCAL_PHONE = re.compile(r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}")
GROUPED_CARD = re.compile(r"[0-9]{4}([.\x20_-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}")
SPELLED_IP = re.compile(r"[0-9]{1,3}(?: ?[\[(](?:\.|dot)[\])] ?[0-9]{1,3}){3}", re.I)


def shape(piece: str) -> str:
    """What a segment looks like as a whole."""
    if "@" in piece:
        m = TAIL.search(piece)
        return "email" if m and m.end() == len(piece) and LOCAL.match(piece) else "other"
    if "[" in piece or "(" in piece[1:]:
        if SPELLED.fullmatch(piece):
            return "spelled"
        if SPELLED_IP.fullmatch(piece):
            return "spelled ip"
    if piece.count(".") == 3 and IP.fullmatch(piece) and all(map(_small, piece.split("."))):
        return "ip"
    n = sum(map(piece.count, "0123456789"))
    if piece[0] == "+" and 9 <= n <= 15 and PHONE.fullmatch(piece):
        return "international"
    if n == 10 and LOCAL_PHONE.fullmatch(piece):
        return "national"
    if n == 16 and GROUPED_CARD.fullmatch(piece):
        return "grouped"
    return "digits" if 12 <= n <= 19 and CARD.fullmatch(piece) else "other"


LEAST_DIGITS, MOST_DIGITS = 4, 20
RUN = re.compile(r"[0-9]+")


def features(text: str, a: int, b: int) -> list[str]:
    """Names of what holds for the segment text[a:b] under any kind, as many for each segment."""
    piece = text[a:b]
    looks = shape(piece)
    runs = RUN.findall(piece)
    digits = "".join(runs)
    n = len(digits)
    lettered = any(c.isalpha() for c in piece)
    marks = "".join(sorted({c for c in piece if not c.isalnum()}))
    plain = not lettered and "@" not in piece
    names = [
        "any",
        f"shape {looks}",
        f"digits {n if n < 20 else 20}",
        f"luhn {n >= 13 and luhn(digits)}",
        f"left {text[a - 1 : a].isalnum()}",
        f"right {text[b : b + 1].isalnum()}",
        f"more {text[b : b + 1] in ('.', '-', ' ', '/') and text[b + 1 : b + 2].isdigit()}",
        f"less {text[a - 1 : a] in ('.', '-', '+', '/') and a > 0}",
        f"behind {a > 1 and text[a - 1] == ' ' and text[a - 2].isdigit()}",
        f"odd {not (piece[-1].isalnum() and (piece[0].isalnum() or piece[0] in '+('))}",
        f"runs {'-'.join(str(len(r)) for r in runs) if plain else 'lettered'}",
        f"groups {min(len(runs), 7)} {plain}",
        f"marks {marks if plain else 'lettered'}",
        f"signs {'@' in piece} {lettered}",
        f"spaced {', ' in piece or '  ' in piece or '. ' in piece}",
        f"zero {plain and digits[:1] == '0'} {min(n, 12)}",
        f"longest {max(map(len, runs), default=0) if plain else 'lettered'}",
        f"card {n >= 13 and luhn(digits) and plain} {max(map(len, runs), default=0) >= 4} {len(set(marks)) < 2}",
    ]
    return names


def cued(before: str, kind: str, names: list[str]) -> list[str]:
    """Names of the words ahead, alone and with the digits; before: lower-case words ahead."""
    cue = any(w in before for w in CUES[kind])
    other = before.rstrip(" :#.").endswith(OTHERS)
    return [f"cue {cue}", f"cue {cue} {names[2]}", f"cue {cue} {names[11]}", f"other {other}", f"other {other} {names[1]}"]


def _segments(text: str, tokens: list[tuple[int, int]]):
    """(first token, last + 1) of candidates: on one line, starting and ending well, with a sign."""
    n = len(tokens)
    heads = [text[a:b] for a, b in tokens]
    for i, head in enumerate(heads):
        if not (head[0].isalnum() or head in ("+", "(", "_", "%")):
            continue
        letters, signed, digits = False, False, 0
        for j in range(i, min(n, i + MOST_TOKENS)):
            t = heads[j]
            first = t[0]
            if t in "\n\r\t" or j > i and t == " " and heads[j - 1] == " ":
                break
            number = t.isdecimal() and t.isascii()
            digits += len(t) if number else 0
            signed = signed or t == "@" or t.lower() == "at"
            letters = letters or any(c.isalpha() for c in t)
            if digits > MOST_DIGITS and not letters:
                break
            if letters and t == " " and not (j and heads[j - 1] in "[]()") and not (j + 1 < n and heads[j + 1] in "[("):
                break
            if (signed or digits >= LEAST_DIGITS and not letters or letters and digits >= 4 and "[" in heads[i:j]) and (number or t[-1].isalnum() or t == ")"):
                yield i, j + 1


def _lattice(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, str, list[str]]]:
    """Every segment as a candidate of each kind, with features."""
    out = []
    for i, j in _segments(text, tokens):
        a, b = tokens[i][0], tokens[j - 1][1]
        if text[a - 1 : a].isalnum() and a or text[b : b + 1].isalnum():  # inside a word or a key
            continue
        names = features(text, a, b)
        before = text[max(0, a - 24) : a].lower()
        for kind in KINDS:
            out.append((i, j, kind, names + cued(before, kind, names)))
    return out


def tokens_of(text: str, a: int, b: int) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(text, a, b)]


def decode(text: str, a: int, b: int, weights: Weights) -> list[tuple[str, int, int]]:
    """The best segmentation of text[a:b]: (kind, start, end) of its entities."""
    tokens = tokens_of(text, a, b)
    by_end: dict[int, list] = {}
    for i, j, kind, names in _lattice(text, tokens):
        own = weights[kind]
        score = sum([own.get(x, 0.0) for x in names])
        if score > 0:
            by_end.setdefault(j, []).append((i, kind, score))
    best, back = [0.0] * (len(tokens) + 1), [None] * (len(tokens) + 1)
    for j in range(1, len(tokens) + 1):
        best[j] = best[j - 1]
        for i, kind, score in by_end.get(j, ()):
            if best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, (i, kind)
    out, j = [], len(tokens)
    while j:
        if back[j]:
            i, kind = back[j]
            end = tokens[j - 1][1]
            while kind == "email" and "@" not in text[tokens[i][0] : end] and (more := MORE.match(text, end)):
                end = more.end()
            out.append((kind, tokens[i][0], end))
            j = i
        else:
            j -= 1
    return out[::-1]


def _examples(n: int = 1200, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Sentences with their entities, and sentences with numbers that are none."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(("an", "er", "th", "on", "re", "la", "de", "ti", "sch", "ue")) for _ in range(rng.randint(1, 4)))
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card():
        stem = digits(rng.choice((12, 14, 15, 15, 15)))
        return next(stem + c for c in "0123456789" if luhn(stem + c))

    def cut_up(c, sizes, mark):
        ends = [sum(sizes[:k]) for k in range(len(sizes) + 1)]
        parts = [c[p:q] for p, q in zip(ends, ends[1:], strict=False)]
        return "".join(p + (mark or rng.choice(" -./")) for p in parts[:-1]) + parts[-1]

    layouts = {13: [(4, 4, 5), (1, 4, 4, 4)], 15: [(4, 6, 5), (5, 5, 5), (4, 4, 4, 3)], 16: [(4, 4, 4, 4), (4, 4, 4, 4), (8, 8), (6, 10)]}

    def grouped(good=True):
        c = card() if good else wrong()
        while len(c) not in layouts:
            c = card() if good else wrong()
        return cut_up(c, rng.choice(layouts[len(c)]), rng.choice((" ", "-", ".", "_", "/", "")))

    def wrong():
        while luhn(d := digits(rng.choice((13, 14, 15, 16)))):
            pass
        return d

    octets = lambda: [str(rng.randint(0, 255)) for _ in range(4)]
    part = lambda k: "0" + digits(k - 1)
    national = [lambda: f"{part(3)} {digits(4)} {digits(4)}", lambda: f"{part(4)}{rng.choice('/- ')}{digits(rng.randint(6, 8))}", lambda: f"{part(5)} {digits(6)}", lambda: rng.choice(". ").join((part(2), digits(2), digits(2), digits(2), digits(2))), lambda: f"({part(rng.randint(3, 5))}) {digits(3)} {digits(4)}", lambda: f"{part(3)} {digits(7)}", lambda: f"00 {digits(2)} {digits(2)} {digits(7)}", lambda: f"00{digits(2)} {digits(3)} {digits(7)}", *[lambda: f"{digits(3)}-{digits(4)}"] * 3, lambda: rng.choice(". ").join((digits(3), digits(3), digits(4))), lambda: f"1-{digits(3)}-{digits(3)}-{digits(4)}"]
    year = lambda: str(rng.randint(1800, 2099))
    month = lambda: f"{rng.randint(1, 28):02}"

    def spelled():
        dot = rng.choice((" [dot] ", " (dot) ", ".", "[dot]"))
        name = rng.choice((".", "_", "-", "")).join(word() for _ in range(rng.choice((1, 1, 2, 3))))
        return name + rng.choice((" [at] ", " (at) ", "[at]", "(at)")) + dot.join([*(word() for _ in range(rng.choice((1, 1, 1, 2, 3)))), rng.choice(("com", "org", "de", "net"))])

    make = {
        "email": [lambda: f"{word()}.{digits(2)}@{word()}{digits(1)}.example.com", lambda: f"{word()}_{word()}@{word()}.org", spelled, spelled],
        "ip": [lambda: ".".join(octets()), lambda: "[.]".join(octets())],
        "card": [card, grouped],
        "phone": [lambda: f"+{rng.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"+{digits(11)}", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}", lambda: f"+{digits(2)} {digits(3)} {digits(4)} {digits(3)}", *national, *national],
    }
    announced = [lambda: f"{digits(3)}.{digits(7)}", lambda: f"{digits(3)} {digits(7)}", lambda: digits(10), lambda: f"{digits(3)} {digits(4)}", lambda: f"{digits(4)} {digits(4)}", lambda: f"{digits(5)} {digits(5)}", lambda: f"{digits(3)}/{digits(3)}-{digits(4)}", lambda: f"{digits(2)} {digits(2)} {digits(2)} {digits(2)}"]
    plain = [wrong, lambda: digits(rng.randint(1, 12)), lambda: f"{digits(1)}.{digits(2)}", lambda: f"{digits(4)}-{digits(2)}-{digits(2)}", lambda: f"{digits(3)} {digits(3)}", lambda: f"{digits(2)}.{digits(1)}.{digits(2)}", lambda: f"{digits(1)},{digits(3)},{digits(3)}", lambda: f"{rng.randint(256, 999)}.{digits(3)}.{digits(2)}.{digits(2)}", lambda: f"+{digits(3)}", lambda: f"{digits(2)}:{digits(2)}", lambda: f"{word()}@", lambda: f"at {digits(2)}"]
    plain += [lambda: grouped(False), lambda: f"{month()}/{month()}/{year()}", lambda: f"{month()}.{month()}.{year()}", lambda: f"{year()}-{month()}-{month()}", lambda: f"{year()}-{year()}", lambda: f"{year()} {year()}", lambda: f"{digits(3)}.{digits(rng.randint(1, 7))}", lambda: f"{rng.randint(1, 99)}.{digits(rng.randint(3, 7))}", lambda: f"{month()}:{month()}:{month()}", lambda: " ".join(digits(rng.randint(1, 2)) for _ in range(rng.randint(3, 8))), lambda: " ".join(digits(rng.randint(3, 5)) for _ in range(rng.randint(2, 4))), lambda: ", ".join(digits(rng.randint(1, 4)) for _ in range(rng.randint(2, 6))), lambda: f"978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}", lambda: f"{digits(3)}/{digits(4)}", lambda: f"{digits(2)}-{digits(2)}", lambda: f"{digits(3)}-{digits(3)}", lambda: f"{rng.randint(1, 9)}.{digits(3)}.{digits(3)}", lambda: f"{year()}-{month()}-{month()} {month()}:{month()}", lambda: f"{word()}-{digits(4)}", lambda: f"{digits(5)}-{digits(4)}", lambda: f"{rng.randint(1, 999)},{digits(3)},{digits(3)}.{digits(2)}", lambda: f"{rng.randint(1, 999)},{digits(3)}.{digits(2)}"]
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            text += " ".join(word() for _ in range(rng.randint(1, 5))) + " "
            if rng.random() < 0.5:
                kind = rng.choice(KINDS)
                told = rng.random() < 0.5
                if told:
                    text += rng.choice(CUES[kind]) + " "
                value = rng.choice(make[kind] + announced if told and kind == "phone" else make[kind])()
                spans.append((kind, len(text), len(text) + len(value)))
            elif rng.random() < 0.3:  # looks like an entity, but is said to be something else
                text += rng.choice(OTHERS) + rng.choice((" ", ": ", " # ")) + ""
                value = rng.choice([*plain, *national, *announced, lambda: f"{digits(3)}.{digits(3)}.{digits(4)}", lambda: f"{digits(4)} {digits(4)} {digits(4)} {digits(4)}"])()
                if any(luhn(m) for m in re.findall("[0-9]{13,19}", re.sub("[ -]", "", value))):
                    value = year()
            else:
                value = rng.choice(plain)()
            text += value + rng.choice((" ", ", ", ". ", "\n"))
        out.append((text, spans))
    return out


@lru_cache(1)
def trained(rounds: int = 40, rate: float = 0.5) -> Weights:
    """Weights of greatest conditional likelihood, by gradient ascent over forward-backward sums."""
    data, names, found, gold = [], {}, [], []
    for text, spans_ in _examples():
        tokens = tokens_of(text, 0, len(text))
        right = {(a, b, k) for k, a, b in spans_}
        ends, starts, at = {}, {}, len(found)
        for i, j, kind, own in _lattice(text, tokens):
            ends.setdefault(j, []).append((len(found), i)), starts.setdefault(i, []).append((len(found), j))
            found.append([names.setdefault((kind, x), len(names)) for x in own])
            gold.append((tokens[i][0], tokens[j - 1][1], kind) in right)
        pairs = lambda d: [(k, *(np.array(x) for x in zip(*v, strict=True))) for k, v in sorted(d.items())]
        data.append((len(tokens), at, len(found), pairs(ends), pairs(starts)[::-1]))
    ids, gold = np.array(found, np.int64), np.array(gold, float)
    w, square = np.zeros(len(names)), np.full(len(names), 1e-8)
    for _ in range(rounds):
        scores, chance = w[ids].sum(1), np.zeros(len(ids))
        for n, first, last, ends, starts in data:
            ahead, behind, done = np.zeros(n + 1), np.zeros(n + 1), 0
            for j, rows, i in ends:
                ahead[done + 1 : j] = ahead[done]
                ahead[j] = _sum(ahead[j - 1], ahead[i] + scores[rows])
                done = j
            ahead[done + 1 :] = ahead[done]
            done = n
            for i, rows, j in starts:
                behind[i + 1 : done] = behind[done]
                behind[i] = _sum(behind[i + 1], behind[j] + scores[rows])
                done = i
            for _, rows, i in ends:
                chance[rows] = ahead[i] + scores[rows] - ahead[n]
            for _, rows, j in starts:
                chance[rows] += behind[j]
        slope = -1e-3 * w + np.bincount(ids.ravel(), np.repeat(gold - np.exp(np.minimum(0.0, chance)), ids.shape[1]), len(w)) / len(data)
        square += slope * slope
        w += rate * slope / np.sqrt(square)
    out: Weights = {k: {} for k in KINDS}
    for (kind, x), i in names.items():
        out[kind][x] = float(w[i])
    return out


def _sum(one: float, more: np.ndarray) -> float:
    """The logarithm of the sum of exponentials."""
    top = max(one, more.max())
    return top + np.log(np.exp(one - top) + np.exp(more - top).sum())


def _windows(text: str) -> list[tuple[int, int]]:
    """Places with a sign and what surrounds it, never ending inside a run without white space."""
    out: list[list[int]] = []
    for m in SIGN.finditer(text):
        if out and m.end() + AROUND <= out[-1][1]:
            continue
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        least = out[-1][1] if out else 0
        while a > least and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find(text: str, weights: Weights) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
    """Base spans by kind, and the spans that the model adds."""
    kinds = base(text)
    taken = joined(s for v in kinds.values() for s in v)
    ends = [q for _, q in taken]
    added = []
    for a, b in _windows(text):
        for kind, x, y in decode(text, a, b, weights):
            k = bisect_right(ends, x)  # the first taken span that ends after x
            if k == len(taken) or taken[k][0] >= y:
                added.append((kind, x, y))
    return kinds, added


def joined(pieces) -> list[list[int]]:
    """Overlapping spans as one, in order."""
    out: list[list[int]] = []
    for a, b in sorted(pieces):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): array of (kind, start, end, base) by kind as listed and start, per row."""
    weights = trained()
    order = {k: i for i, k in enumerate(KINDS)}

    def start():
        def work(batch):
            rows = []
            for text in strings(batch.column(1)):
                kinds, added = find(text, weights)
                all_ = [(k, a, b, True) for k, v in kinds.items() for a, b in v] + [(k, a, b, False) for k, a, b in added]
                rows.append([dict(zip(("kind", "start", "end", "base"), x, strict=True)) for x in sorted(all_, key=lambda x: (order[x[0]], x[1], x[2]))])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "found"])

        return work

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_texts(rows, start, "doc_id long, found array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def redact(text: str, weights: Weights) -> str:
    """The text with each span, joined where they overlap, replaced by the kind of its first."""
    kinds, added = find(text, weights)
    every = sorted([(a, b, k) for k, v in kinds.items() for a, b in v] + [(a, b, k) for k, a, b in added])
    if not every:
        return text
    first = {a: k for a, _, k in reversed(every)}
    out, at = [], 0
    for a, b in joined((a, b) for a, b, _ in every):
        out += [text[at:a], f"<{first[a]}>"]
        at = b
    return "".join([*out, text[at:]])


def redacted(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with the text's spans replaced; other columns as they are, a null text stays null."""
    small_batches(df.sparkSession)
    weights = trained()
    at = df.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = [None if t is None else redact(t, weights) for t in b.column(at).to_pylist()]
            columns = [pa.array(texts, b.schema.field(at).type) if i == at else c for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return df.mapInArrow(run, df.schema)


def measured(seed: int = 1234, n: int = 600) -> dict[str, tuple[float, float]]:
    """(recall, precision) of each kind on generated sentences that training has not seen, base spans
    included."""
    weights = trained()
    hits, wanted, given = ({k: 0 for k in KINDS} for _ in range(3))
    for text, right in _examples(n, seed):
        kinds, added = find(text, weights)
        got = {(k, a, b) for k, v in kinds.items() for a, b in v} | set(added)
        for k, a, b in right:
            wanted[k] += 1
            hits[k] += (k, a, b) in got
        for k, _, _ in got:
            given[k] += 1
    return {k: (hits[k] / max(1, wanted[k]), hits[k] / max(1, given[k])) for k in KINDS}
