"""Personal data in texts, also behind simple disguises.

Plain e-mail addresses, IP addresses, card and phone numbers are found in the text as it
stands. Every text then passes a chain of transducers that map look-alike characters to
ASCII, at/dot words to ``@`` and ``.``, and spelled digits to digits. Each output character
keeps the span of its source, so identifiers found in the output are reported at their place
in the source text. Only texts in which no transducer finds anything to change skip the chain.

Case table: a null or empty text has no spans; offsets are code points of the source, end
exclusive; spans of one start are in the order of ``KINDS``; a disguised span that overlaps
a plain one of its kind is dropped; repeated rows are searched each; extra columns pass
through."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from depotlens.llm.words import released, slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never ends within a run of digits, so one that may start anywhere starts at a run
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else (2 * digit - 9 if digit > 4 else 2 * digit)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Every address has its at sign after a run of local characters, so the search
    goes from sign to sign and stays linear."""
    sign, end = text.find("@"), 0
    while sign >= 0:
        start = sign
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, sign + 1) if start < sign else None
        if found:
            end = found.end()
            yield start, end, "email"
        sign = text.find("@", max(sign + 1, end))


def _numbers(text: str) -> Iterator[Span]:
    for found in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in found[0].split(".")):
            yield *found.span(), "ip"
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 12 and 12 <= len(digits := _NOT_DIGIT.sub("", found[0])) <= 19 and _luhn(digits):
            yield *found.span(), "card"
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", found[0])) <= 15:
                yield *found.span(), "phone"


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def plain_spans(text: str) -> list[Span]:
    """Identifiers of the text as it stands."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        found.extend(_numbers(text))
    return ordered(found)


# Look-alike characters (fixed values).
_LOOKALIKES = {
    "а": "a", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ѕ": "s", "у": "y", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "К": "K", "М": "M", "О": "O", "Р": "P", "Т": "T", "Х": "X",
    "α": "a", "ν": "v", "ο": "o", "ρ": "p", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Ζ": "Z", "ı": "i", "ɡ": "g", "∂": "d", "․": ".", "。": ".", "·": ".",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹫": "@", "﹢": "+",
}
# Full-width ASCII, and decimal digits of other scripts and styles: (first, how many, first target).
_RUNS = [(0xFF01, 94, "!"), *((c, 10, "0") for c in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6))]
_SPACES = dict.fromkeys(map(chr, (0x00A0, 0x2007, 0x2009, 0x202F)), " ")
_INVISIBLE = dict.fromkeys(map(chr, (0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)), "")
LOOKALIKES = _LOOKALIKES | _SPACES | _INVISIBLE | {chr(a + k): chr(ord(b) + k) for a, n, b in _RUNS for k in range(n)}

_DIGITS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_SPELLED = rf"(?:{'|'.join(_DIGITS)})"
_OPEN, _SHUT = r"[\(\[\{<]", r"[\)\]\}>]"
_LEAD = r"(?:(?<!\s)\s+)?"  # like \s*, but a run of white space is tried once only
_DOTS = rf"(?:\s*{_OPEN}\s*(?:dot|punto|punkt|point)\s*{_SHUT}\s*|\s+dot\s+)"
_I = re.IGNORECASE

Pass = tuple[re.Pattern, Callable[[re.Match], list[tuple[str, int, int]]]]


def _becomes(sign: str) -> Callable[[re.Match], list[tuple[str, int, int]]]:
    return lambda found: [(sign, *found.span())]


def _read_digits(found: re.Match) -> list[tuple[str, int, int]]:
    words = re.finditer(_SPELLED, found[0], _I)
    return [(_DIGITS[w[0].lower()], found.start() + w.start(), found.start() + w.end()) for w in words]


_TRANSDUCERS: list[Pass] = [
    (re.compile("[" + "".join(map(re.escape, LOOKALIKES)) + "]"), lambda m: [(c, *m.span()) for c in LOOKALIKES[m[0]]]),
    (re.compile(rf"(?<![A-Za-z]){_SPELLED}(?:[\s,-]{{1,3}}{_SPELLED})+(?![A-Za-z])", _I), _read_digits),
    (re.compile(rf"(?<![A-Za-z]){_SPELLED}(?=\s+(?:dot|point)\s)", _I), _read_digits),
    (re.compile(rf"(?:(?<=[0-9] dot )|(?<=[0-9] point )){_SPELLED}(?![A-Za-z])", _I), _read_digits),
    (re.compile(r"(?<=[0-9])\s+(?:dot|point)\s+(?=[0-9])", _I), _becomes(".")),
    (re.compile(r"(?<![A-Za-z])plus\s+(?=[0-9])", _I), _becomes("+")),
    (re.compile(rf"{_LEAD}{_OPEN}\s*(?:at|arroba|@)\s*{_SHUT}\s*", _I), _becomes("@")),
    (re.compile(rf"(?<=[A-Za-z0-9_%+-])\s+at\s+(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*{_DOTS}[A-Za-z0-9-]+)", _I), _becomes("@")),
    (re.compile(rf"{_LEAD}{_OPEN}\s*(?:dot|punto|punkt|point|\.)\s*{_SHUT}\s*", _I), _becomes(".")),
    (re.compile(r"(?<=[A-Za-z0-9])\s+dot\s+(?=[A-Za-z0-9])", _I), _becomes(".")),
]

# Each transducer without its surroundings, for a linear search over whole batches: a text
# without any of these passes all transducers unchanged, as each finds nothing in turn.
_WHITE = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
_W = f"[{re.escape(_WHITE)}]"
_CHANGED = (
    rf"(?i)[{''.join(map(re.escape, LOOKALIKES))}]|{_OPEN}{_W}*(?:at|arroba|@|dot|punto|punkt|point|\.){_W}*{_SHUT}"
    rf"|{_SPELLED}[{re.escape(_WHITE)},-]{{1,3}}{_SPELLED}|(?:{_SPELLED}|[0-9]){_W}+(?:dot|point){_W}"
    rf"|{_W}dot{_W}|plus{_W}+[0-9]"
)


def normalised(text: str) -> tuple[str, list[int], list[int]] | None:
    """The text after all transducers, with the source start and end of each character;
    nothing if none applies."""
    starts: list[int] | None = None
    ends: list[int] = []
    plain = text.isascii()  # no look-alike is ASCII
    for pattern, emit in _TRANSDUCERS[plain:]:
        pieces, new_starts, new_ends, done = [], [], [], 0
        for found in pattern.finditer(text):
            if starts is None:
                starts, ends = list(range(len(text))), list(range(1, len(text) + 1))
            out = emit(found)
            pieces += [text[done : found.start()], *(c for c, _, _ in out)]
            new_starts += starts[done : found.start()] + [starts[s] for _, s, _ in out]
            new_ends += ends[done : found.start()] + [ends[e - 1] for _, _, e in out]
            done = found.end()
        if done:
            text = "".join([*pieces, text[done:]])
            starts, ends = new_starts + starts[done:], new_ends + ends[done:]
    return None if starts is None else (text, starts, ends)


def disguised_spans(text: str, plain: list[Span]) -> list[Span]:
    """Identifiers of the normalised text whose source differs from their reading."""
    changed, added = normalised(text), []
    if changed is None:
        return added
    shown, starts, ends = changed
    for start, end, kind in plain_spans(shown):
        first, last = starts[start], ends[end - 1]
        if text[first:last] != shown[start:end] and not any(k == kind and s < last and first < e for s, e, k in plain):
            added.append((first, last, kind))
    return added


def all_spans(texts: pa.Array) -> Iterator[tuple[str, list[Span], list[Span]]]:
    """Each text (a null is empty) with its plain spans, and with all its spans."""
    filled = pc.fill_null(texts, "")
    changed = pc.match_substring_regex(filled, _CHANGED).to_pylist()
    for text, change in zip(filled.to_pylist(), changed, strict=True):
        plain = plain_spans(text)
        more = disguised_spans(text, plain) if change else []
        yield text, plain, ordered(plain + more) if more else plain


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted_text(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by the tag of its kind; of overlapping spans
    the first gives the tag."""
    pieces, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            pieces += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*pieces, text[done:]])


def report(documents: DataFrame) -> DataFrame:
    """Plain and all spans of every document."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [(plain, every) for _, plain, every in all_spans(part.column("text"))]
                counts = [[sum(k == kind for _, _, k in plain) for plain, _ in found] for kind in KINDS]
                digests = [hashlib.sha256(joined(plain).encode()).hexdigest() for plain, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array([joined(e) for _, e in found], pa.string())],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, {counts}, base_sha256 string, spans string")


def redacted(documents: DataFrame) -> DataFrame:
    """``documents`` with every span replaced by its tag, and ``n_chars``, where there
    is one, counted anew. Null texts stay null."""
    names = documents.columns

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [redacted_text(text, spans) for text, _, spans in all_spans(part.column("text"))]
                given = part.column("text").is_null().to_pylist()
                texts = [None if null else text for text, null in zip(texts, given, strict=True)]
                columns = {name: part.column(name) for name in names}
                columns["text"] = pa.array(texts, part.schema.field("text").type)
                if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
                    sizes = [old if t is None else len(t) for t, old in zip(texts, columns["n_chars"].to_pylist(), strict=True)]
                    columns["n_chars"] = pa.array(sizes, part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return documents.mapInArrow(run, documents.schema)
