"""Personal data in texts, plain or disguised, as spans of the source text.

Plain identifiers are found in the text as it is. A transducer then rewrites what
disguises them (look-alike letters, wide and foreign digits, spelled digits, at and
dot in words or brackets or between spaces, character entities, characters without width)
and keeps, for every character that it emits, the span of source characters it came from.
What is found in the rewritten text and covers a disguise is mapped back and added, unless
it lies within a plain span of its kind: where only a part of an identifier is
plain, both the plain span and the whole one are given.

Defined results: null and empty texts have no spans; offsets count code points, the end
is exclusive; repeated rows are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# The name part of an address is the run of its characters before the sign, so
# the search can start at the sign; no pattern looks at a character twice.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NAME = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_NAME_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def plain(text: str) -> list[tuple[str, int, int]]:
    """Identifiers in the text as it is, by kind and place."""
    found = []
    if "@" in text:
        last = 0
        for sign in _DOMAIN.finditer(text):
            start = sign.start()
            while start > last and text[start - 1] in _NAME_CHARACTERS:
                start -= 1
            if start < sign.start():
                found.append(("email", start, sign.end()))
                last = sign.end()
    if not _DIGIT.search(text):
        return found
    for match in _IP.finditer(text):
        if all(len(low := part.lstrip("0")) <= 3 and int(low or "0") <= 255 for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(zip("аеорсухіјѕԁɡһԛԝᴠοανικρτυχАВЕКМНОРСТУХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdghqwvoavikptuxABEKMHOPCTYXIJSABEZHIKMNOPTYX", strict=True))
_SIGNS = {"＠": "@", "．": ".", "﹒": ".", "。": ".", "﹫": "@", "‐": "-", "‑": "-", "–": "-", "＋": "+", "﹢": "+", " ": " "}
_DIGIT_WORDS = {word: str(value) for value, word in enumerate("zero one two three four five six seven eight nine".split())}
_SPELLED = "|".join(_DIGIT_WORDS)
#: Number words that make a larger number of a digit beside them.
_COUNTED = frozenset(
    "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty "
    "ninety hundred thousand million".split()
)
_NO_WIDTH = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|commat|period|plus|lowbar|hyphen|nbsp);"
_NAMED = r"[A-Za-z0-9._%+-]"
_DOT = r"(?:\s*[\[({<]\s*(?:dot|punkt|punto|point)\s*[\])}>]\s*|\s+dot\s+|-dot-)"
_AT = r"(?:\s*[\[({<]\s*(?:at|@|arroba)\s*[\])}>]\s*)"
# A bare "at" is a sign only where a disguised dot follows its next word.
_TOKENS = re.compile(
    rf"(?P<dot>(?<=[A-Za-z0-9]){_DOT}(?=[A-Za-z0-9]))"
    rf"|(?P<at>(?<={_NAMED}){_AT}(?=[A-Za-z0-9])|(?<={_NAMED})\s+at\s+(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*{_DOT}))"
    rf"|(?P<dashed>(?<=[A-Za-z0-9])-at-(?=[A-Za-z0-9]+-dot-))"
    rf"|(?P<apart>(?<={_NAMED})\s+@\s+[A-Za-z0-9-]+(?:\s+\.\s+(?-i:[a-z0-9-]+))*\s+\.\s+(?-i:[a-z]{{2,10}})\b|(?<={_NAMED})(?:\s+@\s*|@\s+)(?=[A-Za-z0-9-]+\.[A-Za-z0-9]))"
    rf"|(?P<entity>{_ENTITY})|(?P<none>[{_NO_WIDTH}]+)"
    rf"|(?P<plus>\bplus[ -](?=(?:{_SPELLED})\b|[0-9]))"
    rf"|(?P<digits>\b(?:{_SPELLED})(?:[ -](?:{_SPELLED}))+\b)"
    rf"|(?P<digit>\b(?:{_SPELLED})\b)",
    re.IGNORECASE,
)
_DIGIT_WORD = re.compile(_SPELLED, re.IGNORECASE)
_HINT = re.compile(rf"{_ENTITY}|[{_NO_WIDTH}]|\s@|@\s|" + r"dot\b|\bplus[ -][0-9]|[\[({<]\s*(?:at|@|arroba|dot|punkt|punto|point)\s*[\])}>]", re.IGNORECASE)
_WORD_BEFORE, _WORD_AFTER = re.compile(r"([A-Za-z]+)[ -]\Z"), re.compile(r"[ -]([A-Za-z]+)")
_PAIR = re.compile(rf"\b(?:{_SPELLED})[ .-](?:{_SPELLED}|[0-9])|[0-9][ .-](?:{_SPELLED})\b", re.IGNORECASE)


def _folded(text: str) -> str:
    """Look-alikes, wide forms and foreign digits as ASCII, character for character."""
    if text.isascii():
        return text
    change = {}
    for char in set(text):
        if char < "\x80":
            continue
        if char in _SIGNS or char in _LOOKALIKES:
            change[ord(char)] = _SIGNS.get(char) or _LOOKALIKES[char]
        elif "！" <= char <= "～":
            change[ord(char)] = chr(ord(char) - 0xFEE0)
        elif (value := unicodedata.decimal(char, None)) is not None:
            change[ord(char)] = str(value)
    return text.translate(change) if change else text


def _beside_digits(folded: str, tokens: list[re.Match]) -> list[bool]:
    """Which tokens are rewritten: all but single spelled digits with no digit, written
    or spelled, beside them after a sign or a disguised dot."""

    def char(place: int, step: int) -> str:
        return folded[place : place + 1] if step > 0 else folded[max(0, place - 1) : place]

    def digit(nth: int, step: int) -> bool:
        """Whether a digit follows (step 1) or precedes (step -1) the token."""
        near, far = (re.Match.start, re.Match.end)[::step]
        place, nth = far(tokens[nth]), nth + step
        if 0 <= nth < len(tokens) and near(tokens[nth]) == place and tokens[nth].lastgroup == "dot":
            place, nth = far(tokens[nth]), nth + step
        elif char(place, step) in (" ", ".", "-"):
            place += step
        else:
            return False
        spelled = 0 <= nth < len(tokens) and near(tokens[nth]) == place and tokens[nth].lastgroup in ("digits", "digit")
        return spelled or bool(_DIGIT.match(char(place, step)))

    def counted(token: re.Match) -> bool:
        """Whether the spelled digits are part of a number such as 'ninety two'."""
        before = _WORD_BEFORE.search(folded, max(0, token.start() - 10), token.start())
        after = _WORD_AFTER.match(folded, token.end())
        return any(m is not None and m[1].lower() in _COUNTED for m in (before, after))

    def changed(nth: int, token: re.Match) -> bool:
        if token.lastgroup not in ("digit", "digits"):
            return True
        return not counted(token) and (token.lastgroup == "digits" or digit(nth, -1) or digit(nth, 1))

    return [changed(nth, token) for nth, token in enumerate(tokens)]


def rewritten(text: str) -> tuple[str, list[int], list[int]] | None:
    """The text without disguises, and the source span of each of its characters;
    nothing if there is no disguise."""
    folded = _folded(text)
    spelled = _HINT.search(folded) or _PAIR.search(folded)
    if folded == text and not spelled:
        return None
    out, starts, ends, at = [], [], [], 0
    tokens = list(_TOKENS.finditer(folded)) if spelled else []
    chosen = _beside_digits(folded, tokens)

    def copy(upto: int) -> None:
        out.append(folded[at:upto])
        starts.extend(range(at, upto))
        ends.extend(range(at + 1, upto + 1))

    for token, change in zip(tokens, chosen, strict=True):
        if not change:
            continue
        copy(token.start())
        if token.lastgroup in ("digits", "digit"):
            for word in _DIGIT_WORD.finditer(folded, *token.span()):
                out.append(_DIGIT_WORDS[word[0].lower()])
                starts.append(word.start())
                ends.append(word.end())
        elif token.lastgroup == "apart":
            for place in (place for place in range(*token.span()) if not folded[place].isspace()):
                out.append(folded[place])
                starts.append(place)
                ends.append(place + 1)
        elif token.lastgroup != "none":
            sign = {"dot": ".", "at": "@", "dashed": "@", "plus": "+"}.get(token.lastgroup) or _folded(html.unescape(token[0]))
            out.append(sign)
            starts.extend([token.start()] * len(sign))
            ends.extend([token.end()] * len(sign))
        at = token.end()
    copy(len(folded))
    return "".join(out), starts, ends


def disguised(text: str, known: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Identifiers that the rewritten text has and the text as it is has not, or not whole."""
    if (found := rewritten(text)) is None:
        return []
    clear, starts, ends = found
    out = []
    for kind, start, end in plain(clear):
        first, last = starts[start], ends[end - 1]
        if text[first:last] == clear[start:end]:
            continue
        if not any(k == kind and a <= first and last <= b for k, a, b in known):
            out.append((kind, first, last))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, the plain spans by kind, their hash, all spans,
    and how many are disguised."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = [f"n_{kind}" for kind in KINDS]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(len(KINDS) + 3)]
            for text in batch.column("text").to_pylist():
                base = plain(text or "")
                more = disguised(text or "", base)
                for i, kind in enumerate(KINDS):
                    out[i].append(sum(k == kind for k, _, _ in base))
                out[-3].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out[-2].append(joined(base + more))
                out[-1].append(len(more))
            kinds = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64()]
            names = ["doc_id", *counts, "base_sha256", "spans", "n_disguised"]
            columns = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in counts)
    return rows.mapInArrow(scan, f"doc_id {kind}, {numbers}, base_sha256 string, spans string, n_disguised long")


def redact(text: str | None, mask: str = "*") -> str | None:
    """The text with every identifier's characters replaced."""
    if not text:
        return text
    base = plain(text)
    chars = list(text)
    for _, start, end in base + disguised(text, base):
        chars[start:end] = mask * (end - start)
    return "".join(chars)
