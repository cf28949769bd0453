"""Scalar expressions: lenient casts, time parts, matches, decays and score formulas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def number(value: Column | str, default: float | None = 0.0) -> Column:
    """Lenient double: bad text, null and NaN give the default."""
    cast = _c(value).try_cast("double")
    clean = F.when(~F.isnan(cast), cast)
    return clean if default is None else F.coalesce(clean, F.lit(float(default)))


def instant(value: Column | str) -> Column:
    """Lenient timestamp: anything unparsable gives null."""
    return _c(value).try_cast("timestamp")


def label(value: Column | str) -> Column:
    return F.least(F.greatest(number(value).cast("int"), F.lit(0)), F.lit(1))


def not_blank(value: Column | str) -> Column:
    return F.trim(_c(value)) != ""


def blank(value: Column | str) -> Column:
    return _c(value).isNull() | (F.trim(_c(value)) == "")


def known(value: Column | str) -> Column:
    return F.coalesce(_c(value).cast("string"), F.lit("unknown"))


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / F.lit(3.6e9)


def non_negative(value: Column | str) -> Column:
    return F.greatest(_c(value), F.lit(0.0))


def is_weekend(ts: Column | str) -> Column:
    return F.weekday(_c(ts)).isin(5, 6).cast("int")


def matches(left: Column | str, right: Column | str) -> Column:
    """1 when equal after null becomes ``unknown``; unknown matches unknown."""
    return (known(left) == known(right)).cast("int")


def recency_decay(age_hours: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + non_negative(number(age_hours)))


def rate(part: Column | str, whole: Column | str) -> Column:
    return F.coalesce(F.try_divide(_c(part).cast("double"), _c(whole).cast("double")), F.lit(0.0))


def freshness_bonus(age_hours: Column | str, max_bonus: float = 0.15) -> Column:
    return F.lit(max_bonus) * F.exp(-non_negative(age_hours) / F.lit(24.0))


def position_bias(rank_position: Column | str) -> Column:
    return F.lit(1.0) / F.greatest(number(rank_position, 999.0), F.lit(1.0))


def content_hash_id(url: Column | str, title: Column | str) -> Column:
    return F.concat(F.lit("rss_"), F.md5(F.concat(_c(url), F.lit("|"), _c(title))))


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def weighted_sum(weights: Mapping[str, float], columns: Mapping[str, Column]) -> Column:
    total = None
    for name, weight in weights.items():
        term = F.lit(float(weight)) * columns[name]
        total = term if total is None else total + term
    return total


# fixed values: heuristic ranking weights
HEURISTIC_WEIGHTS = {
    "item_ctr_prior": 0.35,
    "user_ctr_prior": 0.20,
    "recency_decay": 0.15,
    "preferred_category_match": 0.10,
    "preferred_source_match": 0.10,
    "user_item_embedding_cosine": 0.10,
}

# fixed values: logged and target policy weights
LOGGED_WEIGHTS = {
    "item_ctr": 1.8,
    "user_ctr": 0.8,
    "recency": 0.7,
    "category_match": 0.8,
    "source_match": 0.5,
    "position": 1.0,
}
TARGET_WEIGHTS = {
    "item_ctr": 1.2,
    "user_ctr": 0.6,
    "recency": 1.2,
    "category_match": 1.0,
    "source_match": 0.7,
    "position": 0.6,
}

# fixed values: click-probability logits, earlier and later form
CLICK_LOGIT_V2 = {"bias": -2.2, "category": 1.0, "source": 0.7, "recency": 1.2, "position": 1.1, "activity": 0.3}
CLICK_LOGIT_V3 = {
    "bias": -2.6,
    "category": 1.2,
    "secondary": 0.5,
    "source": 0.7,
    "recency": 0.9,
    "position": 1.1,
    "quality": 0.5,
    "popularity": 0.3,
    "activity": 0.2,
}


def heuristic_score(present: list[str]) -> Column:
    """Weighted sum of the heuristic features; absent or null ones count 0."""
    columns = {name: number(name) if name in present else F.lit(0.0) for name in HEURISTIC_WEIGHTS}
    return weighted_sum(HEURISTIC_WEIGHTS, columns)


def click_probability(terms: Mapping[str, Column], weights: Mapping[str, float] = CLICK_LOGIT_V3) -> Column:
    columns = {"bias": F.lit(1.0), **{k: terms.get(k, F.lit(0.0)) for k in weights if k != "bias"}}
    return sigmoid(weighted_sum(weights, columns))


def pseudo_text(present: list[str]) -> Column:
    """Metadata rendered as words for the text vectoriser."""
    parts = [known(name) for name in ("source", "source_type", "category") if name in present]
    for name, prefix in (
        ("title_length", "titlelen_"),
        ("description_length", "desclen_"),
        ("is_hackernews", "is_hn_"),
        ("is_rss", "is_rss_"),
    ):
        if name in present:
            parts.append(F.concat(F.lit(prefix), F.coalesce(F.col(name).cast("int"), F.lit(0)).cast("string")))
    return F.concat_ws(" ", *parts) if parts else F.lit("unknown")
