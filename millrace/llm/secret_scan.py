"""Secret scans: base patterns plus dictionary-primed zstandard novelty.

Base spans are found by three fixed patterns. Beyond them, every token-like string of a text that has a word for something sensitive is a candidate; with
``near``, only those within so many characters after or before such a word, and the lines or dotted parts that follow one. Its novelty is the number of bytes it adds when it is compressed after ``context`` characters
of its own surroundings, with a dictionary of code words and identifiers: ordinary words, identifiers and anything that already
stands nearby cost little, random keys cost close to their entropy. Candidates over a rate of
marginal bits per character are reported as ``novel`` unless they overlap a base span; novel spans never overlap each other.

Words of one case alone (with hyphens and underscores) are taken for words, as so short a text gives no compressor the means to tell an unknown word from a key;
``plain`` judges them too.

One Arrow map: no shuffle, no state between rows but the dictionary.

Defined cases: null text is empty and has no spans; very long texts are scanned whole, in time linear in their length; spans that start
together are listed in the order assign, access, hex, novel; null ids pass through; repeated rows are scanned each; spans count code
points; bytes that are not UTF-8 are read, and counted, as the replacement character; empty tables give empty results; other columns pass only if asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=\-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_SENSITIVE = re.compile(r"pass(?:word|wd|phrase)|secret|token|api[_-]?key|credential|private|auth|bearer|signature|access[_-]?key|client[_-]?id", re.IGNORECASE | re.ASCII)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=\-]{16,}")
_WORD = re.compile(r"[A-Z]?[a-z]+(?:[_-]+[A-Z]?[a-z]+)*[_-]*|[A-Z_-]+")
_GAP = re.compile(r"[^\S\n]*\n\s*|\.")  # a line break and nothing but white space, or a dot

# Common code words, identifiers and encodings that a candidate may be made of.
IDENTIFIERS = """
import export return function const let var public private protected static final class interface struct package module require include define
def self lambda yield async await try except finally raise throw catch switch case default break continue while for each foreach print
password passwd secret token api_key apikey access_key secret_key client_id client_secret private_key public_key auth authorization bearer credential
username user_name email address config configuration settings environment production development staging localhost endpoint service database
connection session request response header cookie content type application json text html charset utf-8 http https www example com org net
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 00000000000000000000 xxxxxxxxxxxxxxxxxxxx XXXXXXXXXXXXXXXXXXXX 1234567890
version release build date 2023-01-01 2024-12-31 v1.0.0 alpha beta stable latest main master branch commit
your_password_here your_token_here changeme placeholder redacted undefined null none true false test sample dummy
getElementById addEventListener toString valueOf hashCode createElement querySelector innerHTML setAttribute getAttribute
""".strip()


class Scanner:
    def __init__(self, *, context: int = 160, near: int | None = None, bits: float = 6.5, plain: bool = False, level: int = 3):
        self.context, self.near, self.bits, self.plain = context, near, bits, plain
        primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=level)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=primed, write_checksum=False, write_content_size=False)

    def novelty(self, before: str, value: str, after: str) -> float:
        """Marginal compressed bits per character of value in its surroundings."""
        around = (before + " " + after).encode("utf-8", "replace")
        size = lambda b: len(self.compressor.compress(b))
        return 8 * (size(around + b" " + value.encode("utf-8", "replace")) - size(around)) / max(1, len(value))

    @staticmethod
    def base(text: str) -> list[tuple[str, int, int]]:
        """Spans (kind, start, end) of the fixed patterns, by start, then as the kinds are listed."""
        found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
        found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))

    def novel(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Candidates within ``near`` characters after or before a sensitive word, and lines that go on after such a one, whose novelty is over the limit.

        One pass over runs, sensitive words and base spans, each by its own pointer: linear in the text. A run that a sensitive word
        leads to is judged once, as a whole; otherwise words inside it cut it into pieces that don't overlap.
        """
        marks = [m.span() for m in _SENSITIVE.finditer(text)]
        if not marks:
            return []
        out: list[tuple[str, int, int]] = []
        passed, held, last, follows, reach = 0, 0, 0, False, 0  # marks that end before the run; base spans that begin before it, and how far they reach
        for m in _CANDIDATE.finditer(text):
            start, end = m.span()
            while passed < len(marks) and marks[passed][1] <= start:
                passed += 1
            inside = passed
            while inside < len(marks) and marks[inside][1] <= end:
                inside += 1
            within = [x for x in marks[passed:inside] if x[0] >= start]
            ahead = inside < len(marks) and (self.near is None or marks[inside][0] - end <= self.near)
            behind = passed > 0 and (self.near is None or start - marks[passed - 1][1] <= self.near)
            follows = behind or (follows and _GAP.fullmatch(text, last, start) is not None)
            if follows or (ahead and not within):
                spans = [(start, end)]
            else:
                cuts = [start, *[e for x in within for e in x], end]
                spans = list(zip(cuts[::2], cuts[1::2], strict=True)) if within else []
            last, follows = end, follows or bool(within)
            for a, b in spans:
                while held < len(base) and base[held][1] < b:
                    reach = max(reach, base[held][2])
                    held += 1
                value = text[a:b]
                if len(value) < 16 or reach > a or (not self.plain and _WORD.fullmatch(value)):
                    continue
                if self.novelty(text[max(0, a - self.context) : a], value, text[b : b + self.context]) >= self.bits:
                    out.append(("novel", a, b))
        return out

    def scan(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Base spans and all spans."""
        base = self.base(text)
        return base, sorted(base + self.novel(text, base), key=lambda s: (s[1], KINDS.index(s[0])))


def spell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, *, text_column: str = "text", keep: list[str] | None = None, **options: float) -> DataFrame:
    """The ``keep`` columns (by default doc_id), n_assign, n_access, n_hex, n_novel, base_spans and spans of every whole text."""
    keep = keep or ["doc_id"]
    source = docs.select(*[docs[c] for c in keep], F.make_valid_utf8(docs[text_column]).alias("__text"))
    schema = source.drop("__text").schema
    for name in ("n_assign", "n_access", "n_hex", "n_novel"):
        schema = schema.add(name, "long")
    schema = schema.add("base_spans", "string").add("spans", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(**options)
        for batch in batches:
            found = [scanner.scan(t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
            counts = [pa.array([sum(s[0] == kind for s in spans) for _, spans in found], pa.int64()) for kind in KINDS]
            written = [pa.array([spell(x[i]) for x in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *counts, *written], schema.names)

    return source.mapInArrow(run, schema)
