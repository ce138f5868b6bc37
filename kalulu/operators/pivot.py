"""EAV -> wide pivot and fixed-list pivot counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.functions.sqltext import listed, quoted


def eav_pivot_paired(obs: DataFrame, encounters: DataFrame, keys: Sequence[str], spec: Sequence[tuple], pairs: Sequence[tuple[str, str]],
                     group: str = "obs_group_id", **cols) -> DataFrame:
    """As :func:`eav_pivot_encounters`, but the columns of a pair (lead, partner) come from one observation group.

    Of a key's groups with a value of the lead the one of the smallest value is
    taken (then the smallest group id, none first), and the partner is read
    from that group; a partner without a lead in its group is no value.
    """
    paired = {c for pair in pairs for c in pair}
    plain = eav_pivot_encounters(obs, encounters, keys, [e for e in spec if e[0] not in paired], **cols)
    per_group = eav_pivot_encounters(obs, encounters, [*keys, group], [e for e in spec if e[0] in paired], obs_keys=[group], **cols)
    picked = [F.expr(f"min(if(`{a}` is not null, struct(`{a}`, `{group}`, `{b}`), null)) as __p{i}") for i, (a, b) in enumerate(pairs)]
    one = per_group.groupBy(*keys).agg(*picked).selectExpr(
        *keys, *[f"__p{i}.`{c}` as `{c}`" for i, pair in enumerate(pairs) for c in pair])
    return plain.join(one, list(keys), "full")


def eav_pivot_encounters(obs: DataFrame, encounters: DataFrame, keys: Sequence[str], spec: Sequence[tuple],
                         obs_keys: Sequence[str] = (), type_col: str = "encounter_type",
                         group_col: str = "group_concept") -> DataFrame:
    """One row per key with one column per (column, concept, value: a column or SQL
    expression, type filter[, observation-group concept]), in place of one sorted join per concept.
    When a key has several observations of a concept the smallest value is kept.

    ``min`` distributes over any partition of the rows, so the observations
    (the largest table) are first reduced to one row per encounter (plus
    ``obs_keys``) by a partial aggregate, joined to their encounter (which
    brings the visit keys and the encounter type), and only then grouped per
    visit.  The encounter-type filter is applied after the join, where the
    type is known; the observation-group filter before it.
    """
    pre, post = [], []
    for i, (col, concept, kind, etype, *group) in enumerate(spec):
        cond = f"concept = {quoted(concept)}" + (f" and {group_col} = {quoted(group[0])}" if group else "")
        pre.append(F.expr(f"min(if({cond}, {kind}, null)) as __v{i}"))
        post.append(F.expr(f"min(if({type_col} = {quoted(etype)}, __v{i}, null)) as `{col}`" if etype else f"min(__v{i}) as `{col}`"))
    concepts = listed(sorted({e[1] for e in spec}))
    per_enc = obs.where(f"concept in ({concepts})").groupBy("encounter_id", *obs_keys).agg(*pre)
    return per_enc.join(encounters, "encounter_id").groupBy(*keys).agg(*post)
