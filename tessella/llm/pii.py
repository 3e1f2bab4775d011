"""Personal data by anchor expansion: an Aho-Corasick pass finds anchors, local parsers grow and validate spans around them.

Anchors are at-signs, digits, plus signs, schemes and words that announce an identifier. From an anchor a parser reads to
the left and right as far as its kind of span can reach and checks what it has read; text away from anchors is never looked
at again. Base spans are those of the kinds' patterns, leftmost first and without overlap: email, ip (parts up to 255), card
(12 to 19 digits that pass Luhn) and phone (9 to 15 digits); what fails its check is dropped whole. The method adds, where no
base span lies: phones and cards that a dropped match holds between its separators, cards and account numbers that a cue
announces, e-mail addresses with letters beyond ASCII or with (at) and (dot), IPv6 addresses, and credentials in URLs.

Defined cases: a null or blank text has no spans; texts of any length are read whole; offsets count code points, ends are
exclusive; rows that repeat and null ids keep their own rows; other columns are left out of the result, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds in the order in which spans of one start are listed; the first four have base patterns.
KINDS = ("email", "ip", "card", "phone", "account")
#: Words that announce an identifier, and what follows them.
CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account", "konto": "account", "cuenta": "account", "compte": "account", "phone": "phone", "tel": "phone", "fax": "phone", "mobile": "phone"}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WIDE_DOMAIN = re.compile(r"[^\W_](?:[\w-]*\w)?(?:\.[^\W_](?:[\w-]*\w)?)*\.[^\W\d_]{2,}")
_SPELT = re.compile(r"\s?([A-Za-z0-9-]+(?:\s?(?:\.|\(dot\)|\[dot\])\s?[A-Za-z0-9-]+)*\s?(?:\.|\(dot\)|\[dot\])\s?[A-Za-z]{2,})")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_RUN = re.compile(r"[0-9]+")
_AUTHORITY = re.compile(r"([^\s/@:]+:[^\s/@]+)@[^\s/@]+")
_LINK = re.compile(r"(?i:\s*(?:no|number|num|nr)?\b\.?)[\s:#=]{1,3}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9-])")
_ACCOUNT = re.compile(r"[0-9]{6,17}(?![0-9])")
_CALL = re.compile(r"\(?[0-9][ ()./0-9-]{7,}[0-9]")
_HEX = frozenset("0123456789abcdefABCDEF:.")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def is_octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def is_iban(text: str) -> bool:
    text = text.replace(" ", "")
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


@cache
def automaton():
    import ahocorasick

    out = ahocorasick.Automaton()
    for c in "0123456789":
        out.add_word(c, ("digit", 1))
    for word, kind in (("@", "at"), ("+", "plus"), ("::", "colons"), ("://", "scheme"), ("(at)", "spelt"), ("[at]", "spelt")):
        out.add_word(word, (kind, len(word)))
    for cue, kind in CUES.items():
        for form in {cue, cue.capitalize(), cue.upper()}:
            out.add_word(form, (f"cue-{kind}", len(form)))
    out.make_automaton()
    return out


class Spans:
    """Base and added spans of one text. A parser is called with an anchor's first and last position, in order of the latter."""

    def __init__(self, text: str):
        self.text = text
        self.base: list[tuple[int, int, int]] = []
        self.more: list[tuple[int, int, int]] = []
        self.mail_end = self.dotted_end = self.digits_end = 0

    def left(self, at: int, least: int, inside) -> int:
        """Where the stretch of characters that ends before `at` begins."""
        text = self.text
        while at > least and inside(text[at - 1]):
            at -= 1
        return at

    def at(self, first: int, last: int) -> None:
        start = self.left(first, self.mail_end, _LOCAL.__contains__)
        domain = _DOMAIN.match(self.text, last + 1) if start < first else None
        if domain:
            self.mail_end = domain.end()
            self.base.append((start, 0, domain.end()))
            return
        start = self.left(first, self.mail_end, lambda c: c.isalnum() or c in "._%+-")
        domain = _WIDE_DOMAIN.match(self.text, last + 1) if start < first else None
        if domain:
            self.more.append((start, 0, domain.end()))

    def spelt(self, first: int, last: int) -> None:
        end = first - (first > 0 and self.text[first - 1] == " ")
        start, domain = self.left(end, 0, _LOCAL.__contains__), _SPELT.match(self.text, last + 1)
        if start < end and domain:
            self.more.append((start, 0, domain.end()))

    def digit(self, first: int, last: int) -> None:
        if first >= self.dotted_end:
            self.dotted(first)
        if first >= self.digits_end:
            self.chain(first)

    def dotted(self, at: int) -> None:
        """Numbers joined by dots: four by four from the left."""
        found = _DOTTED.match(self.text, at)
        self.dotted_end = found.end()
        if found.group().count(".") < 3:
            return
        runs = [(m.start(), m.end()) for m in _RUN.finditer(self.text, at, found.end())]
        for k in range(0, len(runs) - 3, 4):
            four = runs[k : k + 4]
            if all(is_octet(self.text[a:b]) for a, b in four):
                self.base.append((four[0][0], 1, four[3][1]))

    def chain(self, at: int) -> None:
        """Digits with single blanks or hyphens between them: a card as a whole, or cards between its separators."""
        found = _DIGITS.match(self.text, at)
        self.digits_end = found.end()
        if found.end() - at < 12:
            return
        digits = re.sub("[ -]", "", found.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            self.base.append((at, 2, found.end()))
            return
        runs = [(m.start(), m.end()) for m in _RUN.finditer(self.text, at, found.end())]
        sizes, k = [b - a for a, b in runs], 0
        while k < len(runs):
            n = next((n for n in (4, 3, 1) if sizes[k : k + n] in ([4] * 4, [4, 6, 5]) or n == 1 and 13 <= sizes[k] <= 19), 0)
            own = "".join(self.text[a:b] for a, b in runs[k : k + n])
            if n and own[0] in "3456" and luhn(own):
                self.more.append((runs[k][0], 2, runs[k + n - 1][1]))
                k += n
            else:
                k += 1

    def plus(self, first: int, last: int) -> None:
        found = _PHONE.match(self.text, first)
        if not found:
            return
        runs, n = [m.end() for m in _RUN.finditer(self.text, first, found.end())], 0
        counts = []
        for m in _RUN.finditer(self.text, first, found.end()):
            n += m.end() - m.start()
            counts.append(n)
        if 9 <= n <= 15:
            self.base.append((first, 3, found.end()))
        elif n > 15:  # it has run into the number after it
            fits = [end for end, count in zip(runs, counts, strict=True) if 9 <= count <= 15]
            if fits:
                self.more.append((first, 3, fits[-1]))

    def colons(self, first: int, last: int) -> None:
        start = self.left(first, max(0, first - 46), _HEX.__contains__)  # an address has 45 characters at most
        end = last + 1
        while end < min(len(self.text), last + 48) and self.text[end] in _HEX:
            end += 1
        own = self.text[start:end].rstrip(".:")
        if (start and self.text[start - 1].isalnum()) or (end < len(self.text) and self.text[end].isalnum()) or len(own) > 45:
            return
        if sum(bool(part) for part in own.split(":")) < 3 or not any(c.isdigit() for c in own):
            return
        try:
            ipaddress.IPv6Address(own)
        except ValueError:
            return
        self.more.append((start, 1, start + len(own)))

    def scheme(self, first: int, last: int) -> None:
        found = _AUTHORITY.match(self.text, last + 1, last + 400)
        if found:
            self.more.append((*found.span(1)[:1], 4, found.end(1)))

    def cue(self, kind: str, first: int, last: int) -> None:
        """An identifier right after the word that announces it."""
        link = _LINK.match(self.text, last + 1, last + 20)
        if not link or (first and self.text[first - 1].isalnum()):
            return
        at = link.end()
        if kind == "iban":
            found = _IBAN.match(self.text, at)
            if found:  # a word in capitals may follow the number
                ends = [m.end() for m in re.finditer(r"[A-Z0-9]+", found.group()) if is_iban(found.group()[: m.end()])]
                if ends:
                    self.more.append((at, 4, at + ends[-1]))
        elif kind == "phone":
            found = _CALL.match(self.text, at)
            if found and 9 <= sum(c.isdigit() for c in found.group()) <= 15:
                self.more.append((at, 3, found.end()))
        else:
            found = (_SSN if kind == "ssn" else _ACCOUNT).match(self.text, at)
            if found:
                self.more.append((at, 4, found.end()))

    def parse(self) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """(base, all) as (start, kind, end), in order. What is added overlaps nothing that is there."""
        for last, (kind, length) in automaton().iter(self.text):
            first = last - length + 1
            if kind == "digit":
                if first >= self.dotted_end or first >= self.digits_end:
                    self.digit(first, last)
            elif kind.startswith("cue-"):
                self.cue(kind[4:], first, last)
            else:
                getattr(self, kind)(first, last)
        self.base.sort()
        if not self.more:
            return self.base, self.base
        return self.base, sorted(self.base + without_overlap(sorted(self.base), sorted(set(self.more))))


def without_overlap(taken: list[tuple[int, int, int]], more: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of `more` that meet no span before them and none of `taken`; both are in order."""
    out, k, end = [], 0, 0
    for span in more:
        while k < len(taken) and taken[k][0] < span[2]:
            end = max(end, taken[k][2])
            k += 1
        if end <= span[0]:
            out.append(span)
            end = span[2]
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans])


def find(text: str | None) -> tuple:
    """n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of one text."""
    base, every = Spans(text or "").parse()
    counts = [0] * 4
    for _, kind, _ in base:
        counts[kind] += 1
    said = written(base)
    return (*counts, hashlib.sha256(said.encode()).hexdigest(), said if every is base else written(every), len(every) - len(base))


COLUMNS = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


def find_spans(docs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """`keys` (doc_id by default), counts of base spans by kind, and all spans of each row's text."""
    import pyarrow as pa

    keys = ["doc_id"] if keys is None else keys

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):  # few whole texts at a time
                part = batch.slice(k, 256)
                found = list(zip(*map(find, part.column(len(keys)).to_pylist()), strict=True))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], *[pa.array(c, t) for c, t in zip(found, kinds, strict=True)]], names=[*keys, *COLUMNS])

    rows = docs.select(*keys, F.col("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema)
    return rows.mapInArrow(scan, f"{schema}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Texts with each span replaced by its kind in angle brackets; `spans` as find_spans gives them, one row a key."""
    text = F.col("text")
    found = F.transform(F.filter(F.split("_pii_spans", ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    step = lambda acc, s: F.struct(F.concat(acc["out"], text.substr(acc["at"], s[1].cast("int") + 1 - acc["at"]), F.format_string("<%s>", s[0])).alias("out"), (s[2].cast("int") + 1).alias("at"))
    joined = docs.join(spans.select(F.col(key).alias("_pii_key"), F.col("spans").alias("_pii_spans")), F.col(key).eqNullSafe(F.col("_pii_key")), "left")
    joined = joined.withColumn("_pii_cut", F.aggregate(found, start, step))
    rest = F.concat("_pii_cut.out", text.substr(F.col("_pii_cut.at"), F.length("text")))
    return joined.withColumn("text", F.when(F.coalesce("_pii_spans", F.lit("")) == "", text).otherwise(rest)).select(*docs.columns)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
