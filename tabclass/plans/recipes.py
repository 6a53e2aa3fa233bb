"""The four dataset normalisations, as compositions of the operators.

Each recipe is parameterised by its column lists, whose defaults are the
reference dataset's columns, so the same code normalises the real CSVs and the
stand-in tables used for checks.  Every recipe ends with a typed final
projection (the output contract) and never uses a chain of ``withColumn``.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tabclass.functions.calendar import day_of_week, hour_of_day, parse_timestamp, year_diff
from tabclass.functions.geo import haversine_km
from tabclass.operators.columns import (
    CONTRACT_TYPES,
    cast_columns,
    drop_columns,
    rename_snake_case,
    select_contract,
)
from tabclass.operators.quantiles import tercile_target
from tabclass.operators.rows import (
    dropna_any,
    dropna_subset,
    filter_allowed,
    impute_target_default,
)


def _casts(**groups: Sequence[str]) -> dict[str, str]:
    out: dict[str, str] = {}
    for kind, cols in groups.items():
        for c in cols:
            out[c] = kind
    return out


# --------------------------------------------------------------------- social
@dataclass(frozen=True)
class SocialColumns:
    # Fixed values that must equal the reference: gen_z_social column lists.
    numeric_int: tuple[str, ...] = ("age", "num_platforms_used", "night_usage")
    numeric_double: tuple[str, ...] = (
        "daily_usage_hours",
        "avg_session_minutes",
        "mental_health_score",
        "screen_time_before_sleep",
    )
    categorical: tuple[str, ...] = ("gender", "country", "primary_platform", "purpose")
    target: str = "addiction_level"
    allowed: tuple[str, ...] = ("Low", "Medium", "High")


def normalize_social(df: DataFrame, cols: SocialColumns = SocialColumns(), keep: Sequence[str] = ()) -> DataFrame:
    """double casts, int casts, trimmed strings, drop NULL target, allowed values, contract."""
    df = cast_columns(
        df,
        _casts(double=cols.numeric_double, int=cols.numeric_int, string=[*cols.categorical, cols.target]),
    )
    df = dropna_subset(df, [cols.target])
    df = filter_allowed(df, cols.target, cols.allowed)
    return df.select(*keep, *cols.numeric_int, *cols.numeric_double, *cols.categorical, cols.target)


# ---------------------------------------------------------------------- fraud
@dataclass(frozen=True)
class FraudColumns:
    # Fixed values that must equal the reference: fraud_detection raw columns.
    timestamp: str = "trans_date_trans_time"
    birth: str = "dob"
    lat: str = "lat"
    lon: str = "long"
    merch_lat: str = "merch_lat"
    merch_lon: str = "merch_long"
    amount: str = "amt"
    target: str = "is_fraud"


# Fixed values that must equal the reference: fraud_detection output contract.
FRAUD_CONTRACT = (
    ("amt", "double"),
    ("category", "string"),
    ("gender", "string"),
    ("state", "string"),
    ("city_pop", "int"),
    ("job", "string"),
    ("trans_hour", "int"),
    ("trans_day_of_week", "int"),
    ("age", "int"),
    ("distance_to_merchant", "double"),
    ("is_fraud", "int"),
)


def normalize_fraud(df: DataFrame, cols: FraudColumns = FraudColumns(), keep: Sequence[str] = ()) -> DataFrame:
    """Drop NULL target/amount, calendar + age + distance features, contract, snake case, dropna."""
    df = dropna_subset(df, [cols.target, cols.amount])
    ts = parse_timestamp(cols.timestamp)
    dob = parse_timestamp(cols.birth)
    derived = {
        "trans_hour": hour_of_day(ts),
        "trans_day_of_week": day_of_week(ts),
        "age": year_diff(ts, dob),
        "distance_to_merchant": haversine_km(
            F.col(cols.lat).try_cast("double"),
            F.col(cols.lon).try_cast("double"),
            F.col(cols.merch_lat).try_cast("double"),
            F.col(cols.merch_lon).try_cast("double"),
        ),
    }
    df = df.withColumns(derived)
    contract = list(FRAUD_CONTRACT)
    fields = [df.schema[k] for k in keep] + [StructField(n, CONTRACT_TYPES[t], True) for n, t in contract]
    df = select_contract(df.select(*[f.name for f in fields]), StructType(fields))  # keys keep their types
    return dropna_any(rename_snake_case(df))


# -------------------------------------------------------------------- matches
@dataclass(frozen=True)
class MatchesColumns:
    drop: tuple[str, ...] = ()
    strings: tuple[str, ...] = ()
    longs: tuple[str, ...] = ()
    ints: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    target: str = "win"
    allowed: tuple[str, ...] = ("1", "0")
    missing_target: str = "impute"


def lol_matches_columns() -> MatchesColumns:
    """The reference's lol_matches lists (fixed values, see FIXTURES)."""
    # Fixed values that must equal the reference: columns dropped before casting.
    drop = (
        "game_id", "game_start_utc", "map_id", "participant_id", "puuid", "summoner_id",
        "summoner_name", "summoner_level", "champion_id", "platform_id", "game_mode",
        "game_type", "queue_id", "game_version", "individual_position", "lane", "role",
        "game_duration", "item0", "item1", "item2", "item3", "item4", "item5", "item6",
        "solo_tier", "solo_rank", "solo_lp", "solo_wins", "solo_losses", "flex_tier",
        "flex_rank", "flex_lp", "flex_wins", "flex_losses", "champion_mastery_lastPlayTime_utc",
    )
    # Fixed values that must equal the reference: kept columns by type.
    strings = ("champion_name", "team_position")
    longs = (
        "total_damage_dealt", "total_damage_dealt_to_champions",
        "physical_damage_dealt_to_champions", "magic_damage_dealt_to_champions",
        "true_damage_dealt_to_champions", "damage_dealt_to_objectives",
        "damage_dealt_to_turrets", "total_damage_taken", "physical_damage_taken",
        "magic_damage_taken", "true_damage_taken", "champion_mastery_points",
        "champion_mastery_pointsSinceLastLevel", "champion_mastery_pointsUntilNextLevel",
        "champion_mastery_lastPlayTime",
    )
    ints = (
        "team_id", "kills", "deaths", "assists", "baron_kills", "dragon_kills",
        "gold_earned", "gold_spent", "vision_score", "wards_placed", "wards_killed",
        "vision_wards_bought_in_game", "time_ccing_others", "champion_mastery_level",
        "champion_mastery_tokensEarned",
    )
    doubles = (
        "final_abilityHaste", "final_abilityPower", "final_armor", "final_armorPen",
        "final_armorPenPercent", "final_attackDamage", "final_attackSpeed",
        "final_bonusArmorPenPercent", "final_bonusMagicPenPercent", "final_ccReduction",
        "final_cooldownReduction", "final_health", "final_healthMax", "final_healthRegen",
        "final_lifesteal", "final_magicPen", "final_magicPenPercent", "final_magicResist",
        "final_movementSpeed", "final_omnivamp", "final_physicalVamp", "final_power",
        "final_powerMax", "final_powerRegen", "final_spellVamp",
    )
    return MatchesColumns(drop=drop, strings=strings, longs=longs, ints=ints, doubles=doubles)


def normalize_matches(df: DataFrame, cols: MatchesColumns | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns, typed casts, trimmed strings, missing target -> "0", allowed values, contract."""
    cols = cols or lol_matches_columns()
    df = drop_columns(df, [c for c in cols.drop if c not in keep])
    df = cast_columns(
        df,
        _casts(int=cols.ints, long=cols.longs, double=cols.doubles, string=[*cols.strings, cols.target]),
    )
    df = impute_target_default(df, cols.target, "0", cols.missing_target)
    df = filter_allowed(df, cols.target, cols.allowed)
    return df.select(*keep, *cols.strings, *cols.longs, *cols.ints, *cols.doubles, cols.target)


# --------------------------------------------------------------------- salary
@dataclass(frozen=True)
class SalaryColumns:
    # Fixed values that must equal the reference: job_salary column lists.
    numeric_int: tuple[str, ...] = ("experience_years", "skills_count", "certifications")
    categorical: tuple[str, ...] = (
        "job_title", "education_level", "industry", "company_size", "location", "remote_work",
    )
    source: str = "salary"
    target: str = "salary_category"
    allowed: tuple[str, ...] = ("Low", "Medium", "High")
    quantile_method: str = "lazy"
    relative_error: float = 0.01


def normalize_salary(
    df: DataFrame,
    cols: SalaryColumns = SalaryColumns(),
    keep: Sequence[str] = (),
    fit_df: DataFrame | None = None,
    fit_filter: Column | None = None,
) -> DataFrame:
    """double salary, drop NULL salary, tercile target, int casts, trimmed strings, contract.

    The cut points are part of the plan (``quantile_method="lazy"``), or computed by a
    job of their own (``approx``, ``exact``); with ``fit_df`` (raw rows) or
    ``fit_filter`` (a condition on the raw rows, e.g. "is a training row") they come
    from those rows only.  The target is one of the labels by construction.
    """
    if fit_filter is not None and fit_df is None:
        fit_df = df.where(fit_filter)
    df = cast_columns(df, {cols.source: "double"})
    df = dropna_subset(df, [cols.source])
    if fit_df is not None:
        fit_df = dropna_subset(cast_columns(fit_df, {cols.source: "double"}), [cols.source])
    df, _cuts = tercile_target(
        df, cols.source, cols.target, cols.quantile_method, cols.relative_error, fit_df=fit_df, drop_source=False
    )
    df = cast_columns(df, _casts(int=cols.numeric_int, string=cols.categorical))
    return df.select(*keep, *cols.numeric_int, *cols.categorical, cols.target)
