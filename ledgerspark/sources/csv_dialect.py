"""What kind of CSV a file is: header, separator, quote, and quoted line breaks.

The first line of every file names the candidates. One distributed pass over the lines then says
how well each candidate fits: how many lines have as many fields as the first line, and how many lines
end inside a quoted field. Everything after the first lines is Spark expressions; per file and
candidate one row of counts reaches the driver, where Spark keeps the list of files as well.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sources.manifest import ONE_FILE
from ledgerspark.sources.seeds import small_table

#: Preferred in this order when several fit equally well; other characters come after them.
SEPARATORS = (",", ";", "\t", "|")
QUOTES = ('"', "'")
NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


@dataclass(frozen=True)
class Dialect:
    """How a file is read.

    ``header`` is None where the first line is data. With ``breaks`` a quoted field goes on in the
    next line; in an ``unclosed`` file one goes on to the end of the file.
    """

    sep: str
    quote: str
    header: tuple[str, ...] | None
    width: int
    breaks: bool
    unclosed: bool = False

    @property
    def columns(self) -> list[str]:
        """Names of the columns: empty ones by position, repeated ones numbered from the second on."""
        names, seen = [], set()
        for k, name in enumerate(self.header or [""] * self.width):
            name = own = name or f"column{k}"
            n = 0
            while own.lower() in seen:
                n += 1
                own = f"{name}_{n}"
            seen.add(own.lower())
            names.append(own)
        return names


def line_table(spark: SparkSession, paths: list[str], encoding: str, *more: Column) -> DataFrame:
    """(path, line) of all lines with a visible character, and ``more`` about their place."""
    if encoding.upper().replace("-", "") == "UTF8":
        lines = spark.read.text(paths).withColumnRenamed("value", "line")
    else:
        options = {"sep": "\u0001", "quote": "", "encoding": encoding}
        lines = spark.read.options(**options).schema("line string").csv(paths)
    # A line that begins with a visible character needs no pattern.
    visible = (F.col("line") >= "!") | F.col("line").rlike(r"[^\x00-\x20]")
    return lines.select(F.col("_metadata.file_path").alias("path"), "line", *more).where(visible)


def header_lines(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> dict[str, str]:
    """First line that is not blank, by file; a file without one is left out.

    One job with a task per file, which stops after its first batch of lines. It runs in a session
    of its own, so the caller's settings stay as they are, and its function is sent by value.
    """

    def first_row(batches: Iterator) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    own = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, ONE_FILE)
    lines = line_table(own, paths, encoding)
    rows = lines.mapInArrow(first_row, "path string, line string").collect()
    return {unquote(r.path): r.line.lstrip("\ufeff") for r in rows}


def first_lines(
    spark: SparkSession, paths: list[str], encoding: str, quotes: list[str]
) -> tuple[dict[str, str], set[str]]:
    """What ``header_lines`` gives, and the files in which a quote may open a field for more than a line.

    Two quotes in a row, as in an empty field, leave a reader outside of quotes where it was outside before;
    files whose ``quotes`` all come so have no line break within quotes. One pass over all lines tells the latter,
    for callers that look at every line anyway: a task reads many small files, and no worker is started for
    each. A second one fetches the first lines by their row numbers, as for a least text Spark would sort
    all lines. One row per file, and per block of a large one, reaches the driver.
    """
    block, row = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    lines = line_table(spark, paths, encoding, block.alias("block"), row.alias("row"))
    bare = [F.replace("line", F.lit(q + q), F.lit("")) for q in quotes]
    quoted = reduce(Column.__or__, [F.contains(b, F.lit(q)) for b, q in zip(bare, quotes, strict=True)])
    aggs = [F.min("row").alias("row"), F.max(quoted.cast("int")).alias("quoted")]
    blocks = sorted(lines.groupBy("path", "block").agg(*aggs).collect(), key=lambda r: r.block, reverse=True)
    first = {r.path: r.row for r in blocks}
    wanted = small_table(spark, [(n,) for n in first.values()], "row long")
    found = {r.path: r for r in lines.join(wanted, "row", "left_semi").collect()}
    if {path: r.row for path, r in found.items()} != first:  # files have changed or were dealt out anew
        heads = header_lines(spark, paths, encoding)
    else:
        heads = {unquote(path): r.line.lstrip("\ufeff") for path, r in found.items()}
    return heads, {unquote(r.path) for r in blocks if r.quoted}


def split_line(line: str, sep: str, quote: str) -> list[str]:
    return next(csv.reader([line], delimiter=sep, quotechar=quote), [""])


class Candidate(NamedTuple):
    """A dialect that a first line may have, and what is expected of the lines after it."""

    sep: str
    quote: str
    width: int
    numbers: tuple[bool, ...]


def candidates(line: str, sep: str | None, quote: str | None) -> tuple[Candidate, ...]:
    """The dialects worth a look: every sign of the first line outside its quotes may separate."""
    out = []
    for q in [quote] if quote else QUOTES:
        bare = re.sub(f"{re.escape(q)}[^{re.escape(q)}]*{re.escape(q)}", "", line)
        signs = dict.fromkeys(c for c in bare if not c.isalnum() and c not in "_ .\r\n\u0000" + "".join(QUOTES))
        for s in [sep] if sep else [*signs] or [SEPARATORS[0]]:
            fields = split_line(line, s, q)
            numbers = tuple(re.match(NUMBER, f) is not None for f in fields)
            out.append(Candidate(s, q, len(fields), numbers))
    return tuple(out)


# Where a reader is before or after a part of a line.
WITHIN_FIELD, FIELD_START, INSIDE_QUOTES, AFTER_QUOTES = range(4)


def walk(line: Column, sep: str, quote: str, inside: bool = False) -> Column:
    """Follow a line as a CSV reader does: struct of the place at its end and the separators met.

    A quote opens a field only where the field starts; elsewhere outside quotes it is a character.
    Inside, it closes the field, and a further one right after it goes on inside. ``inside`` says
    that the line begins within a quoted field.
    """

    def text(place: Column, seps: Column, part: Column) -> Column:
        quoted = place == INSIDE_QUOTES
        more = F.length(part) - F.length(F.replace(part, F.lit(sep)))
        after = F.when(F.endswith(part, F.lit(sep)), FIELD_START).otherwise(WITHIN_FIELD)
        return F.struct(
            F.when(quoted | (part == ""), place).otherwise(after).alias("place"),
            (seps + F.when(quoted, 0).otherwise(more)).alias("seps"),
        )

    def step(state: Column, part: Column) -> Column:
        place = state["place"]
        opens = (place == FIELD_START) | (place == AFTER_QUOTES)
        crossed = F.when(place == INSIDE_QUOTES, AFTER_QUOTES).when(opens, INSIDE_QUOTES).otherwise(place)
        return text(crossed, state["seps"], part)

    parts = F.split(line, re.escape(quote))
    start = text(F.lit(INSIDE_QUOTES if inside else FIELD_START), F.lit(0), F.get(parts, F.lit(0)))
    return F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), start, step)


def field_count(line: Column, sep: str, quote: str) -> Column:
    plain = F.length(line) - F.length(F.replace(line, F.lit(sep)))
    walked = walk(line, sep, quote)["seps"]
    return F.when(F.contains(line, F.lit(quote)), walked).otherwise(plain) + 1


def ends_inside(line: Column, sep: str, quote: str, inside: bool = False) -> Column:
    """Whether the line ends within a quoted field, when it begins as ``inside`` says."""
    walked = walk(line, sep, quote, inside)["place"] == INSIDE_QUOTES
    return F.when(F.contains(line, F.lit(quote)), walked).otherwise(F.lit(inside))


def measure(lines: DataFrame, choice: tuple[Candidate, ...], only_open: bool = False) -> DataFrame:
    """Per file and candidate: lines, those that agree with the first line, those left open.

    ``lines`` come from files whose first lines allow the same candidates. ``begins`` counts lines
    with a field that begins with a quote, ``quoted`` those with one in quotes; ``alike`` counts lines
    with numbers in the very places where the first line has them. ``only_open`` passes by the
    lines without a quote.
    """
    line, found = F.col("line"), []
    if only_open:
        lines = lines.where(F.contains(line, F.lit(choice[0].quote)))
    for k, (sep, quote, width, numbers) in enumerate(choice):
        agrees = field_count(line, sep, quote) == width
        q, s = re.escape(quote), re.escape(sep)
        has_quote = F.contains(line, F.lit(quote))
        begins = has_quote & line.rlike(f"(?:^|{s}){q}")
        quoted = has_quote & line.rlike(f"(?:^|{s}){q}[^{q}]*{q}(?:{s}|$)")
        alike = F.lit(False)
        if any(numbers):
            parts = F.split(line, s)
            same = [
                (F.get(parts, F.lit(i)) == "") | (F.get(parts, F.lit(i)).rlike(NUMBER) == is_number)
                for i, is_number in enumerate(numbers)
            ]
            alike = reduce(Column.__and__, same)
        found.append(
            F.struct(
                F.lit(k).alias("candidate"),
                agrees.alias("agrees"),
                ends_inside(line, sep, quote).alias("open"),
                begins.alias("begins"),
                quoted.alias("quoted"),
                F.coalesce(alike, F.lit(False)).alias("alike"),
            )
        )
    rows = lines.select("path", F.inline(F.array(*found)))
    flags = ["agrees", "open", "begins", "quoted", "alike"]
    return rows.groupBy("path", "candidate").agg(
        F.count("*").alias("lines"), *[F.count_if(f).alias(f) for f in flags]
    )


def detect_dialects(
    spark: SparkSession, heads: dict[str, str], sep: str | None = None, quote: str | None = '"',
    encoding: str = "UTF-8", header: bool | None = True, breaks: bool | None = None,
    marked: set[str] | None = None,
) -> dict[str, Dialect]:
    """The dialect of every file of ``heads``, which ``header_lines`` has returned.

    ``sep`` and ``quote`` None are found out, and so are ``header`` None (the first line is data
    when it has numbers and most lines have theirs in the same places) and ``breaks`` None
    (whether a quoted field may hold line breaks). The best candidate has more than one field
    and agrees with the first line in most lines; the usual separators win ties. The second quote is taken
    where more fields begin with it than with the first, if more lines agree then, or as many and most
    have a field in such quotes. Files whose first lines allow the same are measured together, all of
    them in one job, which is left out when nothing is to be found out. ``marked`` names the files
    that may have a quoted line break, if that is known, as by ``first_lines``.
    """
    choices = {path: candidates(line, sep, quote) for path, line in heads.items()}
    groups: dict[tuple[Candidate, ...], list[str]] = {}
    for path, choice in sorted(choices.items()):
        groups.setdefault(choice, []).append(path)
    parts = []
    for choice, paths in groups.items():
        open_only = len(choice) == 1 and (header is not None or not any(choice[0].numbers))
        if open_only and marked is not None:
            paths = [p for p in paths if p in marked]
        if paths and (not open_only or breaks is None):
            parts.append(measure(line_table(spark, paths, encoding), choice, open_only))
    facts: dict[tuple[str, int], Facts] = {}
    if parts:
        for r in reduce(DataFrame.unionByName, parts).collect():
            facts[unquote(r.path), r.candidate] = Facts(r.lines, r.agrees, r.open, r.begins, r.quoted, r.alike)
    out = {}
    for path, choice in choices.items():
        known = [facts.get((path, k), Facts()) for k in range(len(choice))]
        out[path] = _best(heads[path], choice, known, header, breaks)
    if breaks is None:
        open_files = {path: dialect for path, dialect in out.items() if dialect.breaks}
        for path in unclosed_files(spark, open_files, encoding):
            out[path] = replace(out[path], unclosed=True)
    return out


def unclosed_files(spark: SparkSession, files: dict[str, Dialect], encoding: str = "UTF-8") -> set[str]:
    """Those files whose last quoted field is never closed.

    A line either leaves the state (inside a quoted field or not) alone, turns it round, or sets it.
    The end of a file is inside if the last line that sets the state does so, or not, and an odd
    number of lines after it turn it round.
    """
    groups: dict[tuple[str, str], list[str]] = {}
    for path, dialect in sorted(files.items()):
        groups.setdefault((dialect.sep, dialect.quote), []).append(path)
    out: set[str] = set()
    for (sep, quote), paths in groups.items():
        place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place")
        line = F.col("line")
        lines = line_table(spark, paths, encoding, place).where(F.contains(line, F.lit(quote)))
        outside, inside = (ends_inside(line, sep, quote, x) for x in (False, True))
        lines = lines.select("path", "place", outside.alias("outside"), inside.alias("inside"))
        sets = lines.where("outside = inside").groupBy("path")
        sets = sets.agg(F.max(F.struct("place", "inside")).alias("last"))
        later = lines.where("outside and not inside").join(sets, "path", "left")
        later = later.where(F.col("last").isNull() | (F.col("place") > F.col("last.place")))
        turns = later.groupBy("path").agg(F.count("*").alias("turns"))
        ends = sets.join(turns, "path", "full_outer").select(
            "path",
            F.coalesce("last.inside", F.lit(False)).alias("inside"),
            (F.coalesce("turns", F.lit(0)) % 2 == 1).alias("turned"),
        )
        out |= {unquote(r.path) for r in ends.where("inside != turned").select("path").collect()}
    return out


class Facts(NamedTuple):
    lines: int = 0
    agrees: int = 0
    open: int = 0
    begins: int = 0
    quoted: int = 0
    alike: int = 0


def _best(
    line: str, choice: tuple[Candidate, ...], known: list[Facts], header: bool | None, breaks: bool | None
) -> Dialect:
    def merit(item: tuple[Candidate, Facts]) -> tuple[bool, int, int]:
        own, fact = item
        usual = -SEPARATORS.index(own.sep) if own.sep in SEPARATORS else -len(SEPARATORS)
        return own.width > 1, fact.agrees, usual

    found = list(zip(choice, known, strict=True))
    quotes = dict.fromkeys(c.quote for c in choice)
    (best, fact), *others = [max((x for x in found if x[0].quote == q), key=merit) for q in quotes]
    for other, its in others:
        better = its.agrees > fact.agrees or (its.agrees == fact.agrees and 2 * its.quoted > its.lines)
        if its.begins > fact.begins and better:
            best, fact = other, its
    is_data = header is False or (header is None and fact.alike > 1 and 2 * fact.alike > fact.lines)
    names = None if is_data else tuple(split_line(line, best.sep, best.quote))
    return Dialect(best.sep, best.quote, names, best.width, fact.open > 0 if breaks is None else breaks)
