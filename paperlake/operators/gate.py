"""Quality gate: flag rows by rule, split them, and stop a run that is too dirty."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake import constants as K
from paperlake.functions.feedtext import strip
from paperlake.functions.metadata import is_json
from paperlake.session import materialize
from paperlake.sinks.lake import write_dead_letters

Rules = dict[str, Column]


def backfill_rules() -> Rules:
    return {
        "paper_id": F.col("paper_id").isNotNull(),
        "title": F.col("title").isNotNull() & (F.length("title") > 0),
        "abstract": F.col("abstract").isNotNull() & (F.length("abstract") >= K.MIN_ABSTRACT_CHARS),
    }


def daily_rules(url_prefix: str = K.FEED_URL_PREFIX) -> Rules:
    paper_id, title, abstract, url = (strip(F.col(c)) for c in ("paper_id", "title", "abstract", "url"))
    return {
        "paper_id": F.length(paper_id).between(1, K.MAX_ID_CHARS),
        "title": F.length(title) > 0,
        "abstract": F.length(abstract) >= K.MIN_ABSTRACT_CHARS,
        "url": url.startswith(url_prefix),
    }


def serving_rules(dim: int | None = None) -> Rules:
    """The constraints of the serving table on a row; that keys are unique is checked when it is written."""
    rules = {
        "paper_id": F.col("paper_id").isNotNull() & (F.length("paper_id") <= K.MAX_ID_CHARS),
        "title": F.col("title").isNotNull(),
        "abstract": F.col("abstract").isNotNull(),
        "url": F.col("url").isNotNull(),
        "categories": F.col("categories").isNull() | (F.length("categories") <= K.MAX_CATEGORIES_CHARS),
        "metadata": F.col("metadata").isNull() | is_json(F.col("metadata")),
    }
    if dim is not None:
        rules["embedding"] = F.col("embedding").isNull() | (F.size("embedding") == dim)
    return rules


def gate(df: DataFrame, rules: Rules) -> DataFrame:
    """Add `reject_reasons` (names of broken rules) and `ok`. A rule that is null is broken."""
    broken = [F.when(F.coalesce(rule, F.lit(False)), F.lit(None)).otherwise(F.lit(name)) for name, rule in rules.items()]
    flagged = df.withColumn("reject_reasons", F.array_compact(F.array(*broken)))
    return flagged.withColumn("ok", F.size("reject_reasons") == 0)


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.where("ok").drop("ok", "reject_reasons")


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.where("NOT ok").drop("ok")


def gate_report(flagged: DataFrame) -> DataFrame:
    """Total, valid and invalid rows and the error rate (0 for no rows), in one aggregate."""
    total, invalid = F.count(F.lit(1)), F.count_if(~F.col("ok"))
    return flagged.agg(
        total.alias("total"),
        (total - invalid).alias("valid"),
        invalid.alias("invalid"),
        F.coalesce(F.try_divide(invalid, total), F.lit(0.0)).alias("error_rate"),
    )


@dataclass(frozen=True)
class GateReport:
    total: int
    valid: int
    invalid: int
    error_rate: float


class GateError(RuntimeError):
    def __init__(self, message: str, report: GateReport):
        super().__init__(message)
        self.report = report


def enforce(
    flagged: DataFrame, max_error_rate: float, dlq_path: str | None, empty_is_error: bool = False
) -> tuple[DataFrame, GateReport]:
    """Run the gate: write dead letters, then fail if the error rate is above the limit.

    The flagged rows are computed once and written to shared scratch space, so the source is
    parsed a single time and neither half depends on executor memory. The table is split by
    `ok`: the report counts rows without reading columns, and each half reads only its files.
    """
    staged = materialize(flagged, "gate", partition="ok")
    report = GateReport(**gate_report(staged.select("ok")).first().asDict())
    if dlq_path is not None:
        write_dead_letters(rejected(staged), dlq_path)
    if empty_is_error and report.total == 0:
        raise GateError("the batch holds no records", report)
    if report.error_rate > max_error_rate:
        raise GateError(f"error rate {report.error_rate:.4f} is above the limit {max_error_rate}", report)
    return accepted(staged), report
