"""Controller logs and the programs' own journals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebook.functions.timecols import parse_dotted, parse_file_day, parse_stamp

# The layouts of the journals.
ACTION_LINE = r"^(\d\d\.\d\d\.\d\d \d\d:\d\d:\d\d) - (?:(\d+) )?Отключилась Cell (\d+); (.+?)\s*$"
PROCESS_LINE = r"^(\d\d:\d\d:\d\d) - (.*)$"
OLD_PROCESS_LINE = r"^(\d\d\.\d\d\.\d\d \d\d:\d\d:\d\d) - (\d+) (.*)$"
AUTO_VENT_LINE = r"^(\d{4}-\d\d-\d\d_\d\d:\d\d:\d\d) / (\S+) / температура: (-?\d+) / автоматика: (\S+)\s*$"
HAND_VENT_LINE = (
    r"^(\d{4}-\d\d-\d\d_\d\d:\d\d:\d\d) \| VENTILATION_V1_(ON|OFF) \| VENTILATION_V5_(ON|OFF) \|/ "
    r"температура: (-?\d+) / автоматика: (\S+)\s*$"
)
RESTART_TEXT = "Перезапуск g2"
REBOOT_TEXT = "Перезагрузка КБС"
VENT_ON_WORD = "включена"


def with_log_place(lines: DataFrame, path: str) -> DataFrame:
    """Controller from the folder and day from the name ``yyMMdd.log`` of a file, or of a folder of its parts."""
    log = F.regexp_replace(path, r"(\.log)/[^/]*$", "$1")
    return lines.withColumn("controller", F.regexp_extract(log, r"([^/=]+)/[^/]*$", 1)).withColumn(
        "log_date", parse_file_day(F.regexp_extract(log, r"(\d{6})\.log$", 1))
    )


def write_cell_log(lines: DataFrame, path: str, order: str, whole: bool = False) -> None:
    """Land lines as text, a folder ``<controller>/<yyMMdd>.log`` of parts for each controller and day.

    The parts of a day follow each other by name. With ``whole`` a day is one file, for streams, which order files
    by the time they landed. Lines without a controller or day land under an empty name.
    """
    named = lines.select(
        F.coalesce("controller", F.lit("")).alias("controller"),
        F.concat(F.coalesce(F.date_format("log_date", "yyMMdd"), F.lit("")), F.lit(".log")).alias("log"), order, "line",
    )
    spread = named.repartition("controller", "log") if whole else named.repartitionByRange("controller", "log", order)
    spread.sortWithinPartitions("controller", "log", order).select("controller", "log", "line").write.mode("append").partitionBy(
        "controller", "log"
    ).text(path)


def in_line_order(lines: DataFrame) -> DataFrame:
    """``line_no`` from the file block a line was read from and its place in that block.

    Only for rows as they come from the files, before anything moves them.
    """
    place = F.struct("block", F.monotonically_increasing_id().alias("place"))
    return lines.withColumn("line_no", place).drop("block")


def read_cell_log(spark: SparkSession, path: str) -> DataFrame:
    """Daily controller logs, one row per line, in an order that needs no whole file per row.

    ``line_no`` grows within a log and is not dense: the file and the start of the file block
    the line was read from, then the line's place in that block. Large logs stay split
    over tasks.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")).alias("block"),
    )
    return with_log_place(in_line_order(lines), "path").select(
        "controller", "log_date", "line_no", F.col("value").alias("line")
    )


def _or_null(text) -> F.Column:
    return F.nullif(text, F.lit(""))


def parse_action_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """Station actions: time, station, action; other lines are kept with nulls."""

    def part(i: int):
        return F.regexp_extract(line, ACTION_LINE, i)

    return lines.withColumn("time", parse_dotted(_or_null(part(1)))).withColumn(
        "cell", part(3).try_cast("int")
    ).withColumn("action", _or_null(part(4)))


def parse_process_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """Process messages in both layouts: dated with a line number, or with the clock only."""
    old = F.regexp_extract(line, OLD_PROCESS_LINE, 1)
    new = F.regexp_extract(line, PROCESS_LINE, 1)
    return (
        lines.withColumn("time", parse_dotted(_or_null(old)))
        .withColumn("clock", F.coalesce(_or_null(new), _or_null(F.substring(old, 10, 8))))
        .withColumn("code_line", F.regexp_extract(line, OLD_PROCESS_LINE, 2).try_cast("int"))
        .withColumn(
            "message",
            F.when(old != "", F.regexp_extract(line, OLD_PROCESS_LINE, 3)).when(
                new != "", F.regexp_extract(line, PROCESS_LINE, 2)
            ),
        )
    )


def parse_vent_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """Ventilation journal in both layouts; the automatic one knows only V5."""

    def auto(i: int):
        return F.regexp_extract(line, AUTO_VENT_LINE, i)

    def hand(i: int):
        return F.regexp_extract(line, HAND_VENT_LINE, i)

    is_auto = auto(1) != ""
    return (
        lines.withColumn("time", parse_stamp(F.coalesce(_or_null(auto(1)), _or_null(hand(1)))))
        .withColumn("v1", _or_null(hand(2)))
        .withColumn(
            "v5", F.when(is_auto, F.when(auto(2) == VENT_ON_WORD, "ON").otherwise("OFF")).otherwise(_or_null(hand(3)))
        )
        .withColumn("temp", F.coalesce(_or_null(auto(3)), _or_null(hand(4))).try_cast("int"))
        .withColumn("auto", F.coalesce(_or_null(auto(4)), _or_null(hand(5))))
    )
