"""Provider responses -> RAW rows. Shallow validation; whatever fails goes to the reject table.

Input is a DataFrame of envelopes: competition_code, season, run_id, source, loaded_at and the
response text in `payload`. Only the parts the models depend on are checked; extra keys are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leaguelake.functions.expressions import field
from leaguelake.sources.schemas import BROKEN_LINE, DATASETS, ENVELOPE, RAW_REJECTS, SCHEMAS

_DOC = "_document"
_LIST = "_list"
_ITEM = "_item"
_REASON = "_reason"
_TEXT = "_text"
_TAKEN = "_taken"
MATCH_WITHOUT_ID = "match without id"


@dataclass(frozen=True)
class Landing:
    """Rows ready for a RAW table, and what came of every response.

    `responses` has a line for each response (no reason: it was sound, and `items` rows came out of it) and one
    for each item refused out of a sound response. It is far smaller than the payloads.
    """

    rows: DataFrame
    responses: DataFrame

    @property
    def rejects(self) -> DataFrame:
        return refused(self.responses)


def refused(responses: DataFrame) -> DataFrame:
    return responses.filter(F.col("reason").isNotNull())


def envelope_schema(*more: T.StructField) -> T.StructType:
    return T.StructType([*more, *ENVELOPE.fields, T.StructField(BROKEN_LINE, T.StringType())])


def with_place(lines: DataFrame) -> DataFrame:
    """Adds `arrival`, which orders lines by the time of their file, the file, and the place of the split in it."""
    of_file = "_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start"
    changed, path, block = map(F.col, of_file)
    parts = [F.lpad(F.unix_millis(changed).cast("string"), 20, "0"), path, F.lpad(block.cast("string"), 20, "0")]
    return lines.select("*", F.concat_ws("|", *parts).alias("arrival"))


def with_line(lines: DataFrame) -> DataFrame:
    """Completes `arrival` by the order of lines within a split."""
    line = F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")
    return lines.withColumn("arrival", F.concat_ws("|", "arrival", line))


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Payload files: JSON lines, one response each, `payload` holding the response as text."""
    reader = spark.read.schema(envelope_schema()).option("columnNameOfCorruptRecord", BROKEN_LINE)
    return with_line(with_place(reader.json(path)))


def load_time(moment: Column) -> Column:
    """When a response was fetched; without that, the moment of the run."""
    return F.coalesce(F.col("fetched_at").try_cast("timestamp_ntz"), moment)


def unusable(dataset: Column | str) -> Column:
    """Why a line cannot be given to a unit; null if it can. Only teams may come without a season."""
    dataset = F.lit(dataset) if isinstance(dataset, str) else dataset
    return (
        F.when(F.col(BROKEN_LINE).isNotNull(), "line is not JSON")
        .when(~F.coalesce(dataset.isin(*REQUIREMENTS), F.lit(False)), "unknown dataset")
        .when(F.col("competition_code").isNull(), "missing competition")
        .when(dataset.isin("matches", "standings") & F.col("season").isNull(), "missing season")
    )


def unusable_lines(lines: DataFrame, dataset: Column | str) -> DataFrame:
    """Lines without a usable envelope as rejects. lines: run_id, source and loaded_at besides the envelope."""
    name = F.lit(dataset) if isinstance(dataset, str) else F.when(F.col(BROKEN_LINE).isNull(), dataset)
    reason = unusable(dataset)
    return lines.filter(reason.isNotNull()).select(
        F.coalesce(name, F.lit("unknown")).alias("dataset"), "competition_code", "season", "run_id", "source", "loaded_at",
        reason.alias("reason"), F.coalesce(BROKEN_LINE, "payload").alias("payload"),
    )


def _kind(path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(_DOC, f"$.{path}", "variant"))


def _is_object(path: str) -> Column:
    return F.coalesce(_kind(path).startswith("OBJECT"), F.lit(False))


def _is_text(path: str) -> Column:
    return F.coalesce(_kind(path) == "STRING", F.lit(False))


def _is_integer(path: str) -> Column:
    whole, exact = field(_DOC, path, "bigint"), field(_DOC, path, "double")
    return F.coalesce(whole.cast("double") == exact, F.lit(False))


def _items(path: str) -> Column:
    return F.try_variant_get(_DOC, f"$.{path}", "array<variant>")


def _object_like(item: Column) -> Column:
    """Asked by reading it as a struct of one field, there or not; the schema would be that of every value in it."""
    return F.try_variant_get(item, "$", "struct<id: variant>").isNotNull()


def _is_object_list(_: str) -> Column:
    return F.coalesce(F.forall(_LIST, _object_like), F.lit(False))


# What each response must carry at its top level. The list of a dataset goes by the dataset's name.
REQUIREMENTS: dict[str, list[tuple[str, Callable[[str], Column]]]] = {
    "competitions": [("id", _is_integer), ("code", _is_text), ("name", _is_text)],
    "teams": [("count", _is_integer), ("teams", _is_object_list)],
    "matches": [("matches", _is_object_list)],
    "standings": [("competition", _is_object), ("season", _is_object), ("standings", _is_object_list)],
}


def _reason(dataset: str) -> Column:
    """Why a response is refused; null when it has everything that is required."""
    reason = F.when(F.col(_DOC).isNull(), "payload is not JSON")
    for path, holds in REQUIREMENTS[dataset]:
        reason = reason.when(~holds(path), f"missing or malformed: {path}")
    return reason


def _opened(envelopes: DataFrame, dataset: str, items: Column, fault: Callable[[Column], Column]) -> DataFrame:
    """One line per response, one per item of a sound response; anything refused has a reason.

    Check and split happen inside one generator over the parsed document. A filter on the reason
    would be pushed below the parse and repeat it for every requirement. The list is unpacked once, below
    the generator. Items travel without the response text, which only a refused response keeps.
    """
    reason = _reason(dataset)

    def line(why: Column, item: Column, text: Column, taken: Column = F.lit(0)) -> Column:
        return F.struct(
            why.cast("string").alias(_REASON), item.cast("variant").alias(_ITEM), text.cast("string").alias(_TEXT),
            taken.cast("long").alias(_TAKEN),
        )

    nothing = F.lit(None)
    broken = F.array(line(reason, nothing, F.col("payload")))
    heading = F.array(line(nothing, nothing, nothing, F.size(F.filter(items, lambda item: fault(item).isNull()))))
    each = F.transform(items, lambda item: line(fault(item), item, F.when(fault(item).isNotNull(), F.to_json(item))))
    if "arrival" not in envelopes.columns:
        envelopes = envelopes.withColumn("arrival", F.lit(None).cast("string"))
    known = [c for c in envelopes.columns if c != "payload"]
    parsed = envelopes.withColumn(_DOC, F.try_parse_json("payload")).withColumn(_LIST, _items(dataset))
    return parsed.select(
        *known, F.inline(F.when(reason.isNotNull(), broken).otherwise(F.concat(heading, each)))
    )


def _no_fault(_: Column) -> Column:
    return F.lit(None).cast("string")


def _landing(opened: DataFrame, dataset: str, lifted: Mapping[str, Column]) -> Landing:
    taken = F.col(_REASON).isNull() & F.col(_ITEM).isNotNull()
    rows = opened.filter(taken).withColumn("raw_json", F.col(_ITEM)).withColumns(dict(lifted))
    responses = opened.filter(~taken).select(
        F.lit(dataset).alias("dataset"),
        "competition_code", "season", "run_id", "source", "loaded_at",
        F.col(_REASON).alias("reason"),
        F.col(_TEXT).alias("payload"),
        F.col(_TAKEN).alias("items"),
    )
    return Landing(rows.select(*SCHEMAS[f"raw_{dataset}"].names), responses.select(*RAW_REJECTS.names, "items"))


def land_competitions(envelopes: DataFrame) -> Landing:
    """The whole response in one row."""
    return _landing(_opened(envelopes, "competitions", F.array(_DOC), _no_fault), "competitions", {})


def land_teams(envelopes: DataFrame) -> Landing:
    """One row per team; all rows of a load share its time."""
    return _landing(_opened(envelopes, "teams", F.col(_LIST), _no_fault), "teams", {})


def land_matches(envelopes: DataFrame) -> Landing:
    """One row per match. Its id and matchday are lifted out as text; a match without id is refused."""

    def fault(item: Column) -> Column:
        return F.when(field(item, "id").isNull(), MATCH_WITHOUT_ID)

    opened = _opened(envelopes, "matches", F.col(_LIST), fault)
    return _landing(
        opened, "matches", {"match_id": field("raw_json", "id"), "matchweek": field("raw_json", "matchday")}
    )


def land_standings(envelopes: DataFrame) -> Landing:
    """The whole response in one row, under the UTC date of its load."""
    opened = _opened(envelopes, "standings", F.array(_DOC), _no_fault)
    return _landing(opened, "standings", {"snapshot_date": F.col("loaded_at").cast("date")})


LANDERS: dict[str, Callable[[DataFrame], Landing]] = {
    "competitions": land_competitions,
    "teams": land_teams,
    "matches": land_matches,
    "standings": land_standings,
}
assert set(DATASETS) < set(LANDERS)


def filter_matches(
    matches: DataFrame,
    season: str | None = None,
    matchday: int | None = None,
    status: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """The provider's match filters over RAW match rows; a filter that is None does not apply.

    Season is a partition column, so it prunes files.
    """
    kickoff_day = field("raw_json", "utcDate", "timestamp_ntz").cast("date")
    wanted = [
        (season, lambda v: F.col("season") == v),
        (matchday, lambda v: field("raw_json", "matchday", "bigint") == v),
        (status, lambda v: field("raw_json", "status") == v),
        (date_from, lambda v: kickoff_day >= F.lit(v).cast("date")),
        (date_to, lambda v: kickoff_day <= F.lit(v).cast("date")),
    ]
    for value, condition in wanted:
        if value is not None:
            matches = matches.filter(condition(value))
    return matches


def filter_season(rows: DataFrame, season: str | None = None) -> DataFrame:
    """The provider's season filter for team and standings rows."""
    return rows if season is None else rows.filter(F.col("season") == season)
