"""Personal data, also where it is disguised, with spans in the original text.

Plain identifiers are found in the text as it stands. Then transducers rewrite the text: lookalike letters and digits
become ASCII, spelled digits become digits, written-out "at", "dot" and "plus" become their signs. Each character of
the rewritten text remembers which characters of the source it came from, so what is found there is mapped back.
Only finds that touch a rewritten place are added; plain finds stay as they are.

Works row by row, so nothing moves between tasks. A null text is empty; other columns, null ids and repeated rows pass
through untouched. Every search is linear in the length of the text (digits of one number at most are read twice).
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import ship

KINDS = ("email", "ip", "card", "phone")
SPANS_TYPE = "array<struct<kind:string,start:int,end:int,base:boolean>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_LOCAL_WORD = re.compile(r"[A-Za-z0-9._%+-]*")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str):
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _ips(text: str):
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGITS.findall(m[0])) <= 15:
            yield m.span()


_FINDERS = (_emails, _ips, _cards, _phones)


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    found = []
    for kind, finder in enumerate(_FINDERS):
        if (kind == 0 and "@" not in text) or (kind == 3 and "+" not in text):
            continue
        found.extend((kind, start, end) for start, end in finder(text))
    return found


# --- Disguises -------------------------------------------------------------------------------------------------------

#: Letters of other scripts that look like ASCII letters.
LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТУХЅІЈаеорсухѕіјԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονıɡ",
        "ABEKMHOPCTYXSIJaeopcyxsijdhqwABEZHIKMNOPTYXovig",
        strict=True,
    )
)
#: Characters without width.
INVISIBLE = frozenset("\u00ad\u200b\u200c\u200d\u2060\ufeff")
_SIGNS = frozenset("@.+-()_%")
NUMBER_WORDS = {w: str(n) for n, w in enumerate("zero one two three four five six seven eight nine".split())}
_NUMBER = "|".join(NUMBER_WORDS)
_SPELLED = re.compile(rf"(?i)\b(?:(?:plus[ ,-]+)?(?:{_NUMBER}))(?:[ ,-]+(?:{_NUMBER}|dot)|[ ,-]*[0-9]+)*\b")
_SPELLED_WORD = re.compile(rf"(?i)plus|dot|{_NUMBER}|[0-9]")
#: A spelled number counts from so many spelled digits; fewer count beside other digits.
SPELLED_DIGITS = 4
_BESIDE = r"[ ().,-]{0,3}"
_BEFORE = re.compile(rf"(?i)(?:[0-9]|\b(?:{_NUMBER})){_BESIDE}\Z")
_BEHIND = re.compile(rf"(?i){_BESIDE}(?:[0-9]|(?:{_NUMBER})\b)")
_AT = re.compile(r"(?i)\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*")
_DOT = re.compile(r"(?i)\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*")
#: Not after "at the dot ...", which is prose. So is "at example.com" where no dot is disguised.
_SPOKEN = re.compile(r"(?i)(?<=[A-Za-z0-9_%+-]) at (?!(?:the|an?|this|that) )(?=[A-Za-z0-9-])")
_HOST = re.compile(r"(?i)[A-Za-z0-9-]++(?:(?:\.| dot )[A-Za-z0-9-]++)+")
_DOTTED_LOCAL = re.compile(r"(?i)[A-Za-z0-9] dot [A-Za-z0-9._%+-]++\Z")
_SPOKEN_DOT = re.compile(r"(?i)(?<=[A-Za-z0-9-]) dot (?=[A-Za-z0-9-])")
_TRIGGER = re.compile(
    rf"(?i)[\[({{<]\s*(?:at|dot|@|\.)\s*[\])}}>]|\bdot\b|\b(?:{_NUMBER})[ ,-]+(?:{_NUMBER})\b"
    rf"|[0-9]{_BESIDE}(?:{_NUMBER})\b|\b(?:{_NUMBER}){_BESIDE}[0-9]"
)


@lru_cache(maxsize=65_536)
def fold(char: str) -> str | None:
    """What a character stands for: an ASCII character, nothing at all ("") or None if it is not a disguise."""
    if char < "\x80":
        return None
    if char in INVISIBLE:
        return ""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    plain = unicodedata.normalize("NFKC", char)
    if len(plain) == 1 and plain < "\x80" and (plain.isalnum() or plain in _SIGNS):
        return plain
    value = unicodedata.decimal(char, None)
    return None if value is None else str(value)


class Mapped:
    """A rewritten text; ``starts`` and ``ends`` give the source of each character, ``changed`` whether it is new.

    Nine bytes a character, as a long text would else hold objects for each.
    """

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts = array("i", range(len(text)))
        self.ends = array("i", range(1, len(text) + 1))
        self.changed = bytearray(len(text))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the ranges (from, to, by what), in order and apart; each new character covers its whole range."""
        if not edits:
            return
        text, starts, ends, changed, at = [], array("i"), array("i"), bytearray(), 0
        for begin, end, new in edits:
            text.append(self.text[at:begin])
            starts += self.starts[at:begin]
            ends += self.ends[at:begin]
            changed += self.changed[at:begin]
            drop = begin < end and not new
            if begin < end:
                text.append(new)
                starts += self.starts[begin : begin + 1] * len(new)
                ends += self.ends[end - 1 : end] * len(new)
                changed += b"\1" * len(new)
            at = end
            if drop and end < len(self.changed):  # the character after a dropped one stands for it
                self.changed[end] = 1
        self.text = "".join([*text, self.text[at:]])
        self.starts = starts + self.starts[at:]
        self.ends = ends + self.ends[at:]
        self.changed = changed + self.changed[at:]


def _lookalikes(mapped: Mapped) -> None:
    mapped.rewrite([(i, i + 1, new) for i, c in enumerate(mapped.text) if c > "\x7f" and (new := fold(c)) is not None])


def _spelled_digits(mapped: Mapped, short: bool) -> bool:
    """Write digits for spelled numbers, for those of few digits only if ``short``; whether there are such."""
    edits, few = [], False
    for m in _SPELLED.finditer(mapped.text):
        words = list(_SPELLED_WORD.finditer(m[0]))
        if sum(w[0].lower() in NUMBER_WORDS for w in words) < SPELLED_DIGITS:
            beside = (
                any(w[0].isdigit() for w in words)
                or _BEFORE.search(mapped.text[max(0, m.start() - 12) : m.start()])
                or _BEHIND.match(mapped.text, m.end())
            )
            few = few or bool(beside)
            if not (short and beside):
                continue
        at = m.start()
        for w in words:  # what stands between two digits goes with the second
            new = NUMBER_WORDS.get(w[0].lower()) or {"plus": "+", "dot": "."}.get(w[0].lower(), w[0])
            edits.append((at, m.start() + w.end(), new))
            at = m.start() + w.end()
    mapped.rewrite(edits)
    return few


def _spoken_at(mapped: Mapped, m: re.Match) -> bool:
    """Whether a host with dots follows, one of them or of the local part disguised."""
    host = _HOST.match(mapped.text, m.end())
    if not host:
        return False
    dots = (i for i in range(*host.span()) if mapped.text[i] == ".")
    return (
        " dot " in host[0].lower()
        or any(mapped.changed[i] for i in dots)
        or bool(_DOTTED_LOCAL.search(mapped.text[max(0, m.start() - 64) : m.start()]))
    )


def _signs(mapped: Mapped) -> None:
    for pattern, new in ((_DOT, "."), (_AT, "@")):
        mapped.rewrite([(*m.span(), new) for m in pattern.finditer(mapped.text)])
    mapped.rewrite([(*m.span(), "@") for m in _SPOKEN.finditer(mapped.text) if _spoken_at(mapped, m)])
    text, dots = mapped.text, list(_SPOKEN_DOT.finditer(mapped.text))
    wanted, next_local = set(), -1
    for m in reversed(dots):  # before an at, word by word
        end = _LOCAL_WORD.match(text, m.end(), m.end() + 64).end()
        if text[end : end + 1] == "@" or end == next_local:
            wanted.add(m.start())
            next_local = m.start()
    edits = []
    for m in dots:
        head = _LOCAL_END.search(text, max(0, m.start() - 64), m.start())
        before = head.start() if head else m.start()
        behind_at = edits and edits[-1][1] >= before or before > 0 and text[before - 1] == "@"
        if behind_at or m.start() in wanted or text[m.start() - 1].isdigit() and text[m.end()].isdigit():
            edits.append((*m.span(), "."))
    mapped.rewrite(edits)


def normalised(text: str) -> list[Mapped]:
    """The rewritten texts: none without a disguise, and a second one where spelled numbers of few digits stand beside
    others, as these may be part of a number or not."""
    odd = not text.isascii() and any(c > "\x7f" and fold(c) is not None for c in set(text))
    if not odd and not _TRIGGER.search(text):
        return []
    found = []
    for short in (False, True):
        mapped = Mapped(text)
        if odd:
            _lookalikes(mapped)
        few = _spelled_digits(mapped, short)
        _signs(mapped)
        found.append(mapped)
        if not few:
            break
    return found


def all_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, plain) by kind, then start."""
    plain = plain_spans(text)
    found = {(k, s, e): True for k, s, e in plain}
    added = set()
    for mapped in normalised(text):
        for kind, start, end in plain_spans(mapped.text):
            if not any(mapped.changed[start:end]):
                continue
            first, last = min(mapped.starts[start:end]), max(mapped.ends[start:end])
            if not any(s <= first and last <= e for _, s, e in plain):
                added.add((kind, first, last))
    widest, kept = (-1, -1), []
    for kind, first, last in sorted(added, key=lambda x: (x[0], x[1], -x[2])):  # of two that are nested, the longer
        if widest < (kind, last):
            widest = (kind, last)
            kept.append((kind, first, last))
    for span in kept:
        found.setdefault(span, False)
    return [(*span, base) for span, base in sorted(found.items())]


def _spans(texts):
    import pyarrow as pa

    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
    found = [
        [{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in all_spans(text)] if text else []
        for text in (t.as_py() for t in texts)
    ]
    return pa.array(found, pa.list_(kind))


def find_personal_data(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Add ``spans``: kind, start and end in code points (end exclusive), and whether the plain rules find it."""
    ship(docs.sparkSession)
    return docs.withColumn(spans, F.arrow_udf(_spans, SPANS_TYPE)(F.coalesce(F.col(text), F.lit(""))))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: str) -> str:
    """The text with every find replaced by its kind in brackets; finds that overlap are replaced together."""
    merged: list[list] = []
    for kind, start, end, _ in sorted(all_spans(text), key=lambda s: (s[1], -s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    parts, at = [], 0
    for kind, start, end in merged:
        parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*parts, text[at:]])


def _redacted(texts):
    import pyarrow as pa

    return pa.array([None if t is None else redacted(t) for t in (x.as_py() for x in texts)], pa.string())


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace personal data in ``text``; a null text stays null."""
    ship(docs.sparkSession)
    return docs.withColumn(text, F.arrow_udf(_redacted, "string")(F.col(text)))


def query(docs: DataFrame) -> DataFrame:
    """Counts and digest of the plain finds, and all spans, per document."""
    found = find_personal_data(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("bigint").alias("n_disguised"),
    )
