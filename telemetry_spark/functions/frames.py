"""Stack frames out of symbol lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_spark.config import MAX_FRAMES
from telemetry_spark.schemas import FRAME

# Fixed value: frame index, image name, address, symbol, offset. The symbol is words up to the last plus sign and number;
# nothing backs up, so a long line takes time in proportion.
FRAME_LINE = (
    r"(?U)^\s*+\d++\s++(\S++)\s++0x[0-9a-fA-F]++\s++"
    r"(\S++(?:\s++(?!\+\s++\d++\s*+$)\S++)*+)\s++\+\s++\d++\s*+$"
)


def in_app(file: Column, executable: Column) -> Column:
    return F.coalesce(file == executable, F.lit(False))


def parse_frames(lines: Column, executable: Column) -> Column:
    """Frames of the lines that parse, 500 at most; such a line names an image and a symbol but no line number."""

    def frame(line: Column) -> Column:
        image = F.regexp_extract(line, FRAME_LINE, 1)
        return F.struct(
            image.alias("file"),
            F.lit(None).cast("int").alias("line"),
            F.regexp_extract(line, FRAME_LINE, 2).alias("method"),
            in_app(image, executable).alias("in_app"),
        )

    parsed = F.filter(lines, lambda line: line.rlike(FRAME_LINE))
    return F.coalesce(F.transform(F.slice(parsed, 1, MAX_FRAMES), frame), F.array().cast(f"array<{FRAME}>"))


def raw_frames(lines: Column) -> Column:
    """Frames of a raw signal report: each non-empty line kept whole as the method."""
    kept = F.filter(lines, lambda line: line != "")
    return F.transform(
        kept,
        lambda line: F.struct(
            F.lit(None).cast("string").alias("file"),
            F.lit(None).cast("int").alias("line"),
            line.alias("method"),
            F.lit(False).alias("in_app"),
        ),
    )
