"""PII: base patterns plus a semi-Markov conditional random field over whole spans.

The base patterns find well-formed personal data. The random field adds what they miss, such as
a phone number without its plus sign or an address with spaces around the @. It scores whole
candidate segments (type, number of digits, separators, checksum, neighbours) and finds the best
segmentation of a region by dynamic programming over boundaries and types together; no entity is
longer than MAX_TOKENS tokens. Every entity holds a digit, an @ or the word "at"; regions reach from
there as far as a segment and what its features look at, so the split into regions is exact.

The weights are learnt by maximum likelihood on stretches of a bounded sample of documents, whose
labels are the base matches, together with copies in which the matches are written in freer forms
and with stretches of prose around the word "at".

Null and empty texts have no spans; repeated rows give repeated results; other columns are not
read. Base matches always stay, and an added span never overlaps one.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.llm.common import bounded_sample, collected, map_rows, sha256_hex

KINDS = ("email", "ip", "card", "phone")
LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]")
LOCAL_PART_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

MAX_TOKENS = 16
SAMPLE_DOCUMENTS = 3_000
MAX_REGIONS = 4_000
EPOCHS = 8
MARGIN = 1.0  # an added span must beat leaving its tokens alone by this much

SCHEMA = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        v = int(d) * (1 + n % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, failing ones dropped without another try."""
    found: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and LOCAL_PART.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            found.append(("email", start, last))
        at = text.find("@", max(at + 1, last))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def ordered(spans: list[Span]) -> list[str]:
    return [f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))]


# --- regions and candidate segments -------------------------------------------------------

TRIGGER = re.compile(r"[0-9@]|(?<![^\W_])[aA][tT](?![^\W_])")
SIGN = re.compile(r"[0-9@]")
AT = re.compile(r"(?<![^\W_])[aA][tT](?![^\W_])")
TOKEN = re.compile(r"[^\W_]+|\s+|.", re.S)
MAIL_FORM = re.compile(r"([a-z0-9._%+-]+(?: [a-z0-9._%+-]+)*?)( ?@ ?| at )([a-z0-9-]+(?:(?: ?[.] ?| dot )[a-z0-9-]+)+)")
SEPARATORS = frozenset(" -.()/+@_")


def stretches(text: str, trigger: re.Pattern = SIGN) -> list[tuple[int, int]]:
    """Stretches of words with a trigger and two neighbouring words on either side: what the weights are learnt on."""
    out: list[tuple[int, int]] = []
    size, word_end = len(text), 0
    for m in trigger.finditer(text):
        if m.start() < word_end:
            continue
        start, end = m.start(), m.end()
        for n in range(3):
            while start and not text[start - 1].isspace():
                start -= 1
            while end < size and not text[end].isspace():
                end += 1
            if n == 0:
                word_end = end
            if n < 2:
                start -= start > 0 and text[start - 1] == " "
                end += end < size and text[end] == " "
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def regions(text: str) -> list[tuple[int, int]]:
    """Where entities may be, with all the tokens that the features of a segment look at.

    MAX_TOKENS tokens on the left of a trigger and from there to a word of letters, MAX_TOKENS + 1 on its right.
    """
    out: list[tuple[int, int]] = []
    size, token_end = len(text), 0
    for m in TRIGGER.finditer(text):
        if m.start() < token_end:
            continue
        start, token_end = m.span()
        if text[start] != "@":
            while start and text[start - 1].isalnum():
                start -= 1
            token_end = TOKEN.match(text, start).end()
        end = token_end
        for _ in range(MAX_TOKENS + 1):
            if end < size:
                end = TOKEN.match(text, end).end()
        reached = out[-1][1] if out else 0
        start = _left_edge(text, start, reached)
        if out and start <= reached:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _left_edge(text: str, at: int, least: int) -> int:
    """The start of the region of a token at ``at``; ``least`` if it reaches that far."""
    width = 256
    while at - width > least:
        tokens = list(TOKEN.finditer(text, at - width, at))[1:]  # the first may be cut
        for m in reversed(tokens[: max(0, len(tokens) - MAX_TOKENS + 1)]):
            if m.group()[0].isalpha():
                return m.start()
        width *= 4
    return least


class Region:
    """The tokens of a region and, per token, the entity segments that may start there."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = [m.span() for m in TOKEN.finditer(text)]
        self.words = [text[a:b] for a, b in self.tokens]
        # no segment without a trigger is an entity
        trigger, reach = len(self.words) + MAX_TOKENS, []
        for i in range(len(self.words) - 1, -1, -1):
            trigger = i if TRIGGER.search(self.words[i]) else trigger
            reach.append(trigger < i + MAX_TOKENS)
        self.letters = [-1]  # per token the last word of letters before it
        for i, word in enumerate(self.words):
            self.letters.append(i if word[0].isalpha() else self.letters[-1])
        self.segments = [self._from(i) if near else [] for i, near in enumerate(reversed(reach))]

    def _from(self, i: int) -> list[tuple[int, str, tuple[str, ...]]]:
        first = self.words[i]
        if not (first[0].isalnum() or first in "+("):
            return []
        out = []
        digits, seen = 0, set()
        has_at = False
        for j in range(i, min(len(self.words), i + MAX_TOKENS)):
            word = self.words[j]
            if word.isspace():
                if word != " ":
                    break
                seen.add(" ")
                continue
            if word[0].isalnum():
                if word.isdigit() and word.isascii():
                    digits += len(word)
                    seen.add("9")
                else:
                    has_at |= word.lower() == "at"
                    seen.add("x" if word[0].isalpha() else "m")
            elif word in SEPARATORS:
                seen.add(word)
                has_at |= word == "@"
                if word != ")":
                    continue
            else:
                break
            if digits > 19:
                break
            kinds = self._kinds(i, j, digits, seen, has_at)
            if kinds:
                feats = self._features(i, j, digits, seen)
                mail = self._mail_features(i, j) if "email" in kinds else ()
                out += [(j + 1, k, tuple(f"{k}|{f}" for f in (mail if k == "email" else feats))) for k in kinds]
        return out

    def _kinds(self, i, j, digits, seen, has_at):
        kinds = []
        letters = "x" in seen or "m" in seen
        if has_at and letters and self.words[i][0].isalnum() and self.words[j][0].isalnum():
            kinds.append("email")
        if not letters and "@" not in seen and digits:
            if 4 <= digits <= 12 and "." in seen:
                kinds.append("ip")
            if 13 <= digits <= 19:
                kinds.append("card")
            if 7 <= digits <= 15:
                kinds.append("phone")
        return kinds

    def _mail_features(self, i, j):
        span = self.text[self.tokens[i][0] : self.tokens[j][1]].lower()
        m = MAIL_FORM.fullmatch(span)
        after = self.words[j + 1] if j + 1 < len(self.words) else " "
        goes_on = after in "-_" or after == "." and j + 2 < len(self.words) and self.words[j + 2][0].isalnum()
        if not m:
            return ("bias", "form=None")
        local, sign, domain = m.groups()
        dots = re.findall(r" ?[.] ?| dot ", domain)
        return (
            "bias",
            f"sign={sign}",
            f"dots={min(len(dots), 3)}",
            f"written={sorted(set(dots))}",
            f"sign+written={sign}{sorted(set(dots))}",
            f"local_words={min(local.count(' '), 2)}",
            f"goes_on={goes_on}",
            f"goes_on_left={i > 0 and self.words[i - 1] in '._%+-'}",
            f"ending={2 <= len(re.split(r'[ .]', domain)[-1]) <= 6}",
        )

    def _features(self, i, j, digits, seen):
        span = self.text[self.tokens[i][0] : self.tokens[j][1]]
        groups = [len(w) for w in self.words[i : j + 1] if w.isdigit()]
        numbers = [w for w in self.words[i : j + 1] if w.isdigit() and w.isascii()]
        before = self.words[i - 1] if i else "^"
        after = self.words[j + 1] if j + 1 < len(self.words) else "$"
        word_before = self.words[self.letters[i]].lower() if self.letters[i] >= 0 else "^"
        return (
            "bias",
            f"digits={digits}",
            f"groups={len(groups)}",
            f"sizes={'-'.join(map(str, groups[:6]))}",
            f"signs={''.join(sorted(seen))}",
            f"plus={span[0] == '+'}",
            f"dots={min(span.count('.'), 5)}",
            f"luhn={13 <= digits <= 19 and luhn(''.join(numbers))}",
            f"bytes={len(numbers) == 4 and all(int(n) <= 255 for n in numbers)}",
            f"before={before if not before[0].isalnum() and not before.isspace() else before[0].isspace()}",
            f"after={after if not after[0].isalnum() and not after.isspace() else after[0].isspace()}",
            f"cue={word_before if len(word_before) < 9 else '*'}",
            f"spaces={min(span.count(' '), 4)}",
            f"domain={bool(re.search(r'(@|at) ?[a-z0-9-]+ ?([.]|dot) ?[a-z]', span))}",
        )


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def best_segmentation(region: Region, weights: dict[str, float], margin: float = MARGIN) -> list[tuple[int, int, str]]:
    """(first token, token after the last, kind) of the entities of the best segmentation."""
    n = len(region.words)
    best, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
    for i in range(n):
        if best[i] > best[i + 1]:
            best[i + 1], back[i + 1] = best[i], (i, None)
        for j, kind, feats in region.segments[i]:
            score = best[i] - margin + sum(weights.get(f, 0.0) for f in feats)
            if score > best[j]:
                best[j], back[j] = score, (i, kind)
    out, j = [], n
    while j:
        i, kind = back[j]
        if kind:
            out.append((i, j, kind))
        j = i
    return out[::-1]


def _train_step(region: Region, gold: set[tuple[int, int, str]], weights: dict[str, float], rate: float) -> None:
    """One gradient step on the log-likelihood: gold features minus expected features."""
    n = len(region.words)
    scored = [
        [(j, kind, feats, sum(weights.get(f, 0.0) for f in feats)) for j, kind, feats in region.segments[i]]
        for i in range(n)
    ]
    into: list[list[float]] = [[] for _ in range(n + 1)]
    into[0] = [0.0]
    alpha = [0.0] * (n + 1)
    for i in range(n):
        alpha[i] = _log_sum(into[i])
        into[i + 1].append(alpha[i])
        for j, _, _, score in scored[i]:
            into[j].append(alpha[i] + score)
    alpha[n] = _log_sum(into[n])
    beta = [0.0] * (n + 1)
    for i in range(n - 1, -1, -1):
        beta[i] = _log_sum([beta[i + 1], *(score + beta[j] for j, _, _, score in scored[i])])
    for i in range(n):
        for j, kind, feats, score in scored[i]:
            expected = math.exp(min(0.0, alpha[i] + score + beta[j] - alpha[n]))
            step = rate * (((i, j, kind) in gold) - expected)
            if abs(step) > 1e-4:
                for f in feats:
                    weights[f] += step


def _free_forms(text: str, span: Span) -> list[tuple[str, Span]]:
    """The region with one match written in a freer form, and where that form lies."""
    kind, start, end = span
    value = text[start:end]
    forms = []
    if kind == "phone":
        bare = value.lstrip("+")
        forms += [bare, re.sub(r"^[0-9]{1,3}[ .-]+", "", bare), re.sub(r"[ ()]+", "-", bare).strip("-"), bare.replace("-", ".")]
    elif kind == "email":
        local, _, domain = value.partition("@")
        forms += [value.replace("@", " @ "), value.replace("@", " at "), value.replace("@", " at ").replace(".", " dot ")]
        short = ".".join(domain.split(".")[-2:])
        forms += [f"{local}{sign}{d}" for sign in (" at ", " @ ") for d in (domain.replace(".", " dot "), short, short.replace(".", " dot "))]
    elif kind == "card":
        digits = NOT_DIGIT.sub("", value)
        forms += [".".join(digits[n : n + 4] for n in range(0, len(digits), 4)), " - ".join(digits[n : n + 4] for n in range(0, len(digits), 4))]
    elif kind == "ip":
        forms.append(value.replace(".", " . "))
    return [(text[:start] + f + text[end:], (kind, start, start + len(f))) for f in forms if f and f != value]


def _plain_forms(text: str, span: Span) -> list[str]:
    """The region with a match turned into numbers that are nobody's data: dates, counts, versions."""
    kind, start, end = span
    d = NOT_DIGIT.sub("", text[start:end])
    if kind not in ("card", "phone") or len(d) < 10:
        return []
    plain = [
        f"{d[:4]}-{d[4:6]}-{d[6:8]}", f"{d[:4]}-{d[4:6]}-{d[6:8]} {d[8:10]}:{d[1:3]}:{d[3:5]}", f"{d[:2]}.{d[2:4]}.{d[4:8]}",
        f"{d[:4]}-{d[4:8]}", f"{d[:3]}.{d[3:6]}.{d[6:9]}", f"{d[:1]}.{d[1:3]}.{d[3:4]}", d[:7], d[:8], d[:9], d[:10],
        f"{d[:3]},{d[3:6]},{d[6:9]}", f"{d[:5]}.{d[5:8]}", f"({d[:4]})", f"{d[:3]}-{d[3:6]}", f"{d[:4]} {d[4:8]}",
    ]
    if kind == "card":
        wrong = d[:-1] + str((int(d[-1]) + 5) % 10)
        plain += [wrong, d[:13], wrong[:4] + "-" + wrong[4:8] + "-" + wrong[8:12] + "-" + wrong[12:]]
    forms = [text[:start] + f + text[end:] for f in plain]
    return [f for f in forms if not base_spans(f)]


def training_regions(texts: list[str], limit: int = MAX_REGIONS) -> list[tuple[str, list[Span]]]:
    out, seen = [], set()
    for text in texts:
        for a, b in stretches(text):
            part = text[a:b]
            if part in seen or len(part) > 400:
                continue
            seen.add(part)
            spans = base_spans(part)
            out.append((part, spans))
            for span in spans:
                if len(spans) == 1:
                    out += [(t, [s]) for t, s in _free_forms(part, span)]
                    out += [(t, []) for t in _plain_forms(part, span)]
        if len(out) >= limit:
            break
    return out + prose_regions(texts, limit // 2)


def prose_regions(texts: list[str], limit: int) -> list[tuple[str, list[Span]]]:
    """Stretches around the word "at" without an entity. Those that may be a freer form of an address have no label."""
    parts: dict[str, None] = {}
    for text in texts:
        for a, b in stretches(text, AT):
            part = text[a:b]
            if len(part) <= 400 and not SIGN.search(part) and not base_spans(AT.sub("@", part.replace(" dot ", ".")).replace(" @ ", "@")):
                parts[part] = None
        if len(parts) >= limit:
            break
    return [(part, []) for part in list(parts)[:limit]]


def train(texts: list[str], epochs: int = EPOCHS, limit: int = MAX_REGIONS) -> dict[str, float]:
    """Weights of span features, the same for the same texts in the same order."""
    examples = []
    for part, spans in training_regions(texts, limit):
        region = Region(part)
        starts = {a: i for i, (a, _) in enumerate(region.tokens)}
        ends = {b: i + 1 for i, (_, b) in enumerate(region.tokens)}
        gold = {(starts[s], ends[e], k) for k, s, e in spans if s in starts and e in ends}
        # an entity that no segment can be, such as a longer one, would only teach that its parts are none
        if len(gold) == len(spans) and all((e, k) in {x[:2] for x in region.segments[s]} for s, e, k in gold):
            examples.append((region, gold))
    weights: dict[str, float] = defaultdict(float)
    for epoch in range(epochs):
        for region, gold in examples:
            _train_step(region, gold, weights, 0.3 / (1 + 0.3 * epoch))
    return {f: round(w, 6) for f, w in weights.items() if abs(w) > 1e-3}


def all_spans(text: str, weights: dict[str, float], margin: float = MARGIN) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) in code points."""
    base = base_spans(text)
    added: list[Span] = []
    for a, b in regions(text):
        region = Region(text[a:b])
        for i, j, kind in best_segmentation(region, weights, margin):
            start, end = a + region.tokens[i][0], a + region.tokens[j - 1][1]
            if all(end <= s or e <= start for _, s, e in base):
                added.append((kind, start, end))
    return base, added


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE_DOCUMENTS) -> dict[str, float]:
    """Weights from the stretches of at most ``2 * sample`` documents with a digit, an @ or the word "at"."""
    with_trigger = bounded_sample(docs.select(key, text), key, sample).filter(F.col(f"`{text}`").rlike(r"[0-9@]|\b[aA][tT]\b"))
    return train([r[1] for r in collected(with_trigger)])


def find_personal_data(
    docs: DataFrame, weights: dict[str, float], text: str = "text", keep: tuple[str, ...] = ("doc_id",), margin: float = MARGIN
) -> DataFrame:
    """Columns ``keep``, base counts, the digest of the base spans, and all spans; no shuffle."""

    def make():
        def work(value):
            base, added = all_spans(value or "", weights, margin)
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            return (*counts, sha256_hex(ordered(base)), ",".join(ordered(base + added)), len(added))

        return work

    return map_rows(docs, [text], make, SCHEMA, keep)


def masked(text: str | None, weights: dict[str, float], margin: float = MARGIN) -> str | None:
    """The text with every span replaced by its kind in angle brackets."""
    if not text:
        return text
    base, added = all_spans(text, weights, margin)
    pieces, at = [], 0
    for kind, start, end in sorted(base + added, key=lambda x: (x[1], -x[2])):
        if start >= at:
            pieces += [text[at:start], f"<{kind}>"]
            at = end
        elif end > at:  # overlaps the span before: its rest goes too
            at = end
    return "".join([*pieces, text[at:]])


def without_personal_data(text: Column, weights: dict[str, float], margin: float = MARGIN) -> Column:
    """The masked text as a column: only the text goes to Python. Null stays null."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t, weights, margin) for t in texts], dtype=object)

    return mask(text)
