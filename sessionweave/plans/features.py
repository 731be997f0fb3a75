"""The feature job: prepared event log in, long feature table out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.operators import cleaning, clicks, combos, deltas, levels, longtable, quantiles, stats, vocabulary
from sessionweave.operators.skew import SkewProfile
from sessionweave.presets import FeatureParams

KEYS = stats.KEYS
SHARES = (0.1, 0.2, 0.4, 0.6, 0.8, 0.9)
VALUE_SHARES = (0.2, 0.7, 0.9)

Keep = Callable[..., DataFrame]


def log_bucket(skew: SkewProfile) -> str | None:
    """Column by which a prepared log is bucketed: the session, unless one is too large for a task."""
    return None if skew.has_hot else "session_id"


def _lazy(name: str, build: Callable[[], DataFrame], of: DataFrame | None = None) -> DataFrame:
    return build()


@dataclass
class Dictionaries:
    """Tables fitted on the training log and applied to any log."""

    flr_list: DataFrame
    tl_list: DataFrame
    navigate_master: DataFrame
    vocabulary: DataFrame | None = None


@dataclass
class Features:
    """Long rows, the sessions of each block and the dictionaries that were used."""

    rows: DataFrame
    members: DataFrame
    dictionaries: Dictionaries | None = None


def value_table(log: DataFrame, params: FeatureParams) -> DataFrame:
    """Statistics per (session, dimension, value) of all dimensions."""
    return stats.value_stats(log, [*stats.DIMENSIONS, "word"], params)


def fit_dictionaries(log: DataFrame, params: FeatureParams, keep: Keep = _lazy) -> Dictionaries:
    sessions = combos.group_sessions(log)
    fqid = keep("fqid_cells", lambda: combos.combo_cells(log, combos.FQID_COMBO), of=log)
    text = keep("text_cells", lambda: combos.combo_cells(log, combos.TEXT_COMBO), of=log)
    navigate = keep("navigate_cells", lambda: clicks.navigate_cells(log, params), of=log)
    words = None
    if params.fitted:
        cells = keep("value_stats", lambda: value_table(log, params), of=log)
        words = keep("vocabulary", lambda: vocabulary.fit_vocabulary(cells, sessions, params.fitted))
    return Dictionaries(
        keep("flr_list", lambda: combos.mine_combos(fqid, sessions, combos.FQID_COMBO, params.support)),
        keep("tl_list", lambda: combos.mine_combos(text, sessions, combos.TEXT_COMBO, params.text_support)),
        keep("navigate_master", lambda: clicks.cell_popularity(navigate, params)),
        words,
    )


def session_block(log: DataFrame, params: FeatureParams) -> DataFrame:
    """All plain per-session aggregates in one pass: counts, numeric statistics, flags, milestones."""
    aggs = [F.count("idx").alias("session_number"), *stats.numeric_aggregates()]
    if params.version >= 3:
        aggs += stats.flag_aggregates(params.gap_flags)
    if params.extra:
        spans = stats.milestone_aggregates(params) + stats.transition_aggregates(params)
        table = log.groupBy(*KEYS).agg(*aggs, *spans)
        names = [c for c in table.columns if c not in KEYS][len(aggs) :]
    else:
        table, names = log.groupBy(*KEYS).agg(*aggs), []
    plain = [(c, f"{c}_{{S}}", False) for c in table.columns if c not in [*KEYS, *names]]
    extra = [(c, f"{c}_extra_{{S}}", False) for c in names]
    return longtable.melt(table, "base", plain + extra)


def value_quantiles(log, named: dict[str, tuple], params, skew, listed=None) -> DataFrame:
    """Gap quantiles per value for ``{dimension: (shares, template)}``, all dimensions in one pass.

    ``listed`` leaves out rows of values without features.
    """
    shares = sorted({s for wanted, _ in named.values() for s in wanted})
    rows = stats.value_rows(log, list(named), params, ["elapsed_time_diff"])
    rows = listed(rows) if listed else rows
    keys = [*KEYS, "dimension", "value"]
    table = quantiles.nearest_quantiles(rows, keys, ["elapsed_time_diff"], shares, skew)
    templates = {
        dimension: [
            (quantiles.quantile_name("elapsed_time_diff", s), template.replace("{q}", str(round(s * 10))), False) for s in wanted
        ]
        for dimension, (wanted, template) in named.items()
    }
    return longtable.melt_values(table, list(named), templates)


def session_features(
    log: DataFrame,
    params: FeatureParams,
    skew: SkewProfile,
    dictionaries: Dictionaries | None = None,
    keep: Keep = _lazy,
) -> Features:
    """Long features of a log with deltas, all level groups at once.

    ``keep`` may store an intermediate table that several blocks read;
    ``dictionaries`` are fitted here unless they are given.
    """
    flagged = deltas.gap_flags(log, params.gap_flags)
    x = deltas.cap_gap(flagged, params.gap_cap) if params.cap_gaps else flagged
    blocks = [
        session_block(x, params),
        longtable.melt_columns(stats.session_distincts(x)),
        longtable.melt_columns(quantiles.nearest_quantiles(x, KEYS, list(stats.NUMERIC_COLUMNS), SHARES, skew)),
    ]
    fitted = dictionaries
    if not fitted and (params.version >= 2 or params.room_click or params.fitted):
        fitted = fit_dictionaries(x, params, keep)
    values = keep("value_stats", lambda: value_table(x, params), of=x) if params.fitted else value_table(x, params)
    named = {"event_name": (SHARES, "{c}_ET_quantile{q}_{S}")}
    if params.version >= 4:
        named["text_fqid"] = (VALUE_SHARES, "{c}_text_ET_quantile{q}_{S}")
        named["room_fqid"] = (VALUE_SHARES, "{c}_room_ET_quantile{q}_{S}")
    listed = None
    if params.fitted:
        listed = lambda table: vocabulary.keep_vocabulary(table, fitted.vocabulary, params.fitted)
        values = listed(values)
    blocks.append(longtable.melt_values(values, [*stats.DIMENSIONS, "word"]))
    blocks.append(value_quantiles(x, named, params, skew, listed))

    members = {}
    if params.version >= 2:
        fqid = keep("fqid_cells", lambda: combos.combo_cells(x, combos.FQID_COMBO), of=x)
        text = keep("text_cells", lambda: combos.combo_cells(x, combos.TEXT_COMBO), of=x)
        blocks += [
            longtable.melt(
                combos.combo_features(fqid, fitted.flr_list, combos.FQID_COMBO),
                "base",
                longtable.FQID_COMBO_TEMPLATES,
                F.concat_ws("_", "fqid", "room_fqid", F.col("level").cast("string")),
            ),
            longtable.melt(
                combos.combo_features(text, fitted.tl_list, combos.TEXT_COMBO),
                "base",
                longtable.TEXT_COMBO_TEMPLATES,
                F.concat_ws("_", "text_fqid", F.col("level").cast("string")),
            ),
            longtable.melt(combos.event_pair_counts(x, params), "base", longtable.COUNT_TEMPLATES, F.col("pair")),
            longtable.melt_columns(clicks.repeat_clicks(x, params)),
        ]
    if params.level_diff:
        blocks.append(longtable.melt_columns(levels.level_time_features(x, params)))
    if params.cut_above:
        late = x.where(F.col("level_group").isin(list(params.above_groups)))
        above = keep("above", lambda: levels.above_threshold_features(late, params, skew), of=x)
        blocks.append(longtable.melt(above, "above", longtable.ABOVE_TEMPLATES, F.col("value")))
        members["above"] = above
    if params.room_click:
        cells = keep("navigate_cells", lambda: clicks.navigate_cells(x, params), of=x)
        counts = clicks.navigate_category_counts(cells, fitted.navigate_master, params)
        name = F.concat_ws("_", "room_fqid", F.col("category").cast("string"))
        blocks.append(longtable.melt(counts, "navigate", longtable.NAVIGATE_TEMPLATES, name))
        members["navigate"] = cells
    return Features(longtable.stack_blocks(blocks), longtable.block_members(x, **members), fitted)


@dataclass
class Selection:
    """Selected long rows, their members, and the summaries of all and of kept features."""

    rows: DataFrame
    members: DataFrame
    summary: DataFrame
    kept: DataFrame
    dictionaries: Dictionaries | None = None


def completed_features(
    rows: DataFrame, members: DataFrame, params: FeatureParams, merge: bool = False, noise: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Long rows and members with time parts and noise, and with groups merged if asked for."""
    extra = [longtable.time_rows(members, params.time_parts)]
    if noise:
        sessions = members.where("block = 'base'").select(*KEYS)
        typed = cleaning.noise_features(sessions, noise).withColumns({"block": F.lit("base"), "zero": F.lit(False)})
        extra.append(typed.select(*KEYS, "block", "feature", "zero", "value"))
    if merge:
        # Time parts and noise belong to the first group and reach the others by the merge.
        extra = [e.where(F.col("level_group") == params.level_groups[0]) for e in extra]
    rows = longtable.stack_blocks([rows, *extra])
    return longtable.merge_groups(rows, members, params.level_groups) if merge else (rows, members)


def selected_features(
    features: Features,
    params: FeatureParams,
    drop: DataFrame | None = None,
    merge: bool = False,
    noise: int = 0,
    keep: Keep = _lazy,
) -> Selection:
    """Prune, add time parts and noise, merge groups, drop listed names."""
    listed = longtable.listed_counts(features.rows.sparkSession, params)
    pruned = longtable.prune(longtable.feature_summary(features.rows, features.members, listed), params.null_rate)
    kept_names = keep("pruned", lambda: pruned)
    rows = longtable.keep_features(features.rows, kept_names)
    rows, members = completed_features(rows, features.members, params, merge, noise)
    if merge or noise or params.time_parts:
        names = longtable.carry_names(kept_names, params.level_groups) if merge else kept_names
        summary = keep("summary", lambda: longtable.feature_summary(rows, members, names))
    else:
        # Nothing was added since the first summary: it holds for the rows that were kept.
        summary = kept_names
    if drop is None:
        # The summary names every feature of the rows.
        return Selection(rows, members, summary, summary, features.dictionaries)
    kept = longtable.drop_listed(summary, drop)
    return Selection(longtable.keep_features(rows, kept), members, summary, kept, features.dictionaries)
