"""Mapping-driven CSV extracts to canonical all-text frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockpolicy.config import Mapping, SourceSpec
from stockpolicy.functions.columns import blank_to_null
from stockpolicy.functions.session import file_system
from stockpolicy.schemas import SECTIONS

BROKEN = "broken_line"  # a line whose number of fields is not the header's, as it was written


class ExtractError(ValueError):
    """The extract does not fit its mapping; lists everything that does not."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path (or glob) matches anything, on any Hadoop file system."""
    fs, where = file_system(spark, path)
    return bool(fs.globStatus(where))


@dataclass(frozen=True)
class Source:
    """A section of the extract that can be read."""

    section: str
    path: str
    spec: SourceSpec
    lines: DataFrame  # as `read_text_csv` gives them


def survey(
    spark: SparkSession,
    directory: str,
    mapping: Mapping,
    insist: dict[str, tuple[str, ...]] | None = None,
    multiline: bool = True,
) -> tuple[list[Source], list[str]]:
    """The sections that can be read as mapped, and every problem with the others.

    `insist` names, per section, the columns that must be mapped and present; without it
    required sections must be there, and whatever is mapped must be present.
    """
    sources, problems = [], []
    for section in insist if insist is not None else SECTIONS:
        needed = insist is not None or SECTIONS[section][1]
        spec = mapping.get(section)
        path = f"{directory.rstrip('/')}/{spec.file}" if spec else None
        if path is None or not path_exists(spark, path):
            if needed:
                where = f"nothing at {path}" if path else "no entry in the mapping"
                problems.append(f"{section} is needed: {where}")
            continue
        lines = read_text_csv(spark, path, multiline)
        wanted = [c for c in SECTIONS[section][0] if c in spec.columns] if insist is None else insist[section]
        absent = absent_columns(lines.columns, spec, wanted)
        problems += [f"{section}.{a}" for a in absent]
        if not absent:
            sources.append(Source(section, path, spec, lines))
    return sources, problems


def absent_columns(header: list[str], spec: SourceSpec, wanted) -> list[str]:
    """A text for each wanted column that is not mapped, or mapped to a name the header lacks."""
    has = ", ".join(c for c in header if c != BROKEN)
    texts = {
        c: f"{c} <- {spec.columns[c]!r}, which is not in the header of {spec.file} ({has})"
        if c in spec.columns
        else f"{c} is not mapped"
        for c in wanted
        if spec.columns.get(c) not in header
    }
    return list(texts.values())


def to_canonical(df: DataFrame, section: str, spec: SourceSpec, na_values=()) -> DataFrame:
    """Canonical names in table order; unmapped ones are NULL, other columns fall away.

    Values stay as they are, except that an empty one (or one of `na_values`)
    is NULL. The column of broken lines is kept if there is one.
    """
    canonical, _ = SECTIONS[section]
    absent = absent_columns(df.columns, spec, [c for c in canonical if c in spec.columns])
    if absent:
        raise ExtractError([f"{section}.{a}" for a in absent])

    def value(c: str):
        if c not in spec.columns:
            return F.lit(None).cast("string").alias(c)
        quoted = spec.columns[c].replace("`", "``")
        text = blank_to_null(F.col(f"`{quoted}`").cast("string"))
        if na_values:
            text = F.when(~text.isin(*na_values), text)
        return text.alias(c)

    extra = [BROKEN] if BROKEN in df.columns else []
    return df.select(*(value(c) for c in canonical), *extra)


def read_text_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """CSV with a header, every value a string; a byte-order mark is dropped.

    A line with more or fewer fields than the header is kept whole in `broken_line`, which is NULL
    for the others. `multiline` allows quoted line breaks but reads each file as a whole. A
    large extract should then come as many files (`path` may be a folder or a
    glob); without embedded line breaks pass False, and files are split too.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("encoding", "UTF-8")
    )
    header = reader.csv(path).schema
    if BROKEN in header.names:
        raise ExtractError([f"the header of {path} uses the reserved name {BROKEN}"])
    lines = T.StructType([*header.fields, T.StructField(BROKEN, T.StringType())])
    # Whole lines are parsed even where few columns are asked for, or their width would go unseen.
    # With many files, each one's header must match the first one's.
    whole = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", BROKEN)
    found = whole.schema(lines).option("enforceSchema", False).csv(path)
    # Spark refuses to read the column of broken lines alone, so it is read with an empty piece of another.
    first = F.col("`" + header.names[0].replace("`", "``") + "`")
    return found.withColumn(BROKEN, F.nullif(F.concat_ws("", BROKEN, F.substring(first, 1, 0)), F.lit("")))


def good_lines(canonical: DataFrame) -> DataFrame:
    return canonical.filter(F.col(BROKEN).isNull()).drop(BROKEN)


def broken_lines(canonical: dict[str, DataFrame]) -> DataFrame:
    """(table_name, line) of the lines of a wrong width."""
    parts = None
    for section, df in canonical.items():
        own = df.filter(F.col(BROKEN).isNotNull()).select(
            F.lit(f"raw.{section}").alias("table_name"), F.col(BROKEN).alias("line")
        )
        parts = own if parts is None else parts.unionByName(own)
    if parts is None:
        raise ValueError("no raw tables given")
    return parts


def scan_mapped(
    spark: SparkSession,
    path: str,
    section: str,
    mapping: Mapping,
    multiline: bool = True,
    na_values=(),
    keep_broken: bool = False,
) -> DataFrame:
    """Canonical rows of one section; lines of a wrong width only with `keep_broken`."""
    spec = mapping.get(section)
    if spec is None:
        raise ExtractError([f"{section} has no entry in the mapping"])
    rows = to_canonical(read_text_csv(spark, path, multiline), section, spec, na_values)
    return rows if keep_broken else good_lines(rows)


def load_raw(
    spark: SparkSession, directory: str, mapping: Mapping, multiline: bool = True, na_values=()
) -> dict[str, DataFrame]:
    """All sections of an extract that are present, with their broken lines.

    Raises one error with every problem of the extract.
    """
    sources, problems = survey(spark, directory, mapping, None, multiline)
    if problems:
        raise ExtractError(problems)
    return {s.section: to_canonical(s.lines, s.section, s.spec, na_values) for s in sources}


def raw_row_counts(raw: dict[str, DataFrame]) -> DataFrame:
    counts = None
    for section, df in raw.items():
        one = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(f"raw.{section}").alias("table_name"), "n_rows"
        )
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        raise ValueError("no raw tables given")
    return counts


def assert_counts(found: dict[str, int], expected: dict[str, int | None]) -> dict[str, int]:
    """Fails on an empty required section or an unannounced number of lines; lists all of them."""
    empty = [f"{s} is needed and has no rows" for s, n in found.items() if not n and SECTIONS.get(s, ((), False))[1]]
    other = [
        f"{s} has {n} lines, announced are {expected[s]}"
        for s, n in found.items()
        if n and expected.get(s) and n != int(expected[s])
    ]
    if empty or other:
        raise ExtractError(empty + other)
    return found
