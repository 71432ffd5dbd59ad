"""BPM/Mode enrichment: provider pivot (AGG-7), cache lookup (JOI-6),
attribute-wise fallback chain (JOI-7) and the order-dependent in-batch
cache reuse (JOI-8).

Chain semantics per row: own value, else the cached value (label
``cache``), else each provider in priority order (its label); an own value
has no label.  Providers only fill what is still missing, so the row's
values are a per-attribute ``coalesce`` and the label a matching ``CASE``.

The fold (JOI-8): rows are processed in input order and a row may see the
cache entry written by an earlier row of the same key.  The state of a key
is (present, bpm, mode); a row returns early (state unchanged) when the key
is present and own-or-cached values cover both attributes, otherwise it
writes (own ?? state ?? provider) for both.  The null-pattern of the state
only ever grows (a written non-NULL attribute stays non-NULL), so each
attribute turns non-NULL at most once, at a row found by per-key ``min``
aggregates; the state values are "latest value written before this row",
a running last-non-NULL computed as a scan in levels (scan.py).  No collect:
a key holding a third of all rows is split into bounded chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import num, payload, text
from ..session import ensure_checkpoint_dir
from .common import lookup_join, one_per_key
from .scan import before

PROVIDER_ORDER = ("p1_bpm", "p2_preview", "p3_search", "p4_preview")


def provider_pivot(responses: DataFrame, key: str = "song_key", provider: str = "provider",
                   order: list[str] | None = None, providers=PROVIDER_ORDER) -> DataFrame:
    """(key, provider, rank, payload) -> one row per key with the first
    payload (smallest order) of each provider; a first hit whose payload is
    NULL is kept (no skipping to the second hit)."""
    rows = responses.select(key, F.col(provider).alias("_p"), F.struct(*[F.col(c) for c in order or ["rank"]]).alias("_o"),
                            "payload").where(F.col("_p").isin(list(providers)))
    first = one_per_key(rows, [key, "_p"], "_o")      # at most one row of each provider per key from here on
    return first.groupBy(key).agg(*[F.max(F.when(F.col("_p") == p, F.col("payload"))).alias(p) for p in providers])


def parse_providers(pivot: DataFrame, key: str = "song_key", enable_p3: bool = True) -> DataFrame:
    """Wide payload row -> (key, p*_bpm, p*_mode) typed values, and the analyser
    that each clip analysis names for its BPM and its mode (NULL: the default one)."""
    d = payload.with_deezer_bpm(pivot, "p1_bpm", "_p1b")
    d = payload.with_analysis_bpm_mode(d, "p2_preview", "_p2b", "_p2m", "_p2p")
    d = payload.with_search_bpm_mode(d, "p3_search", "_p3b", "_p3m")
    d = payload.with_analysis_bpm_mode(d, "p4_preview", "_p4b", "_p4m", "_p4p")
    p3b, p3m = F.col("_p3b"), F.col("_p3m")
    if not enable_p3:
        p3b, p3m = F.lit(None).cast("double"), F.lit(None).cast("string")
    return d.select(key, F.col("_p1b").alias("p1_bpm"), F.col("_p2b").alias("p2_bpm"),
                    F.col("_p2m").alias("p2_mode"), p3b.alias("p3_bpm"), p3m.alias("p3_mode"),
                    F.col("_p4b").alias("p4_bpm"), F.col("_p4m").alias("p4_mode"),
                    *[F.col(f"_{p}p_{v}").alias(f"{p}_{v}_by") for p in ("p2", "p4") for v in ("bpm", "mode")])


def _chain(values: list[tuple[Column, Column | str | None]]) -> tuple[Column, Column]:
    val = F.coalesce(*[v for v, _ in values])
    lab = None
    for v, label in values:
        col = label if isinstance(label, Column) else F.lit(label).cast("string")
        lab = F.when(v.isNotNull(), col) if lab is None else lab.when(v.isNotNull(), col)
    return val, lab


def _provider_values(j: DataFrame):
    """(value, label) in priority order; a clip analysis is labelled with the analyser it names."""
    labels = C.PROVIDER_LABELS

    def by(p, v, label):
        return F.coalesce(F.col(f"{p}_{v}_by"), F.lit(label)) if f"{p}_{v}_by" in j.columns else label

    bpm = [(F.col("p1_bpm"), labels["p1_bpm"]), (F.col("p2_bpm"), by("p2", "bpm", labels["p2_preview"])),
           (F.col("p3_bpm"), labels["p3_search"]), (F.col("p4_bpm"), by("p4", "bpm", labels["p4_preview"]))]
    mode = [(F.col("p2_mode"), by("p2", "mode", labels["p2_preview"])), (F.col("p3_mode"), labels["p3_search"]),
            (F.col("p4_mode"), by("p4", "mode", labels["p4_preview"]))]
    return bpm, mode


def _own(df: DataFrame, bpm: str, mode: str) -> DataFrame:
    return df.withColumns({
        "_own_b": num.nan_to_null(num.coerce_number(F.col(bpm))),
        "_own_m": F.when(text.not_missing(mode), F.col(mode).cast("string")),
    })


def _lookups(providers: DataFrame, cache: DataFrame | None, key: str) -> DataFrame:
    """One row per key: provider values plus the cache entry (present flag)."""
    if cache is None:
        return providers.withColumns({"_c_present": F.lit(False), "_c_b": F.lit(None).cast("double"),
                                      "_c_m": F.lit(None).cast("string")})
    c = cache.select(key, F.lit(True).alias("_c_present"),
                     num.nan_to_null(F.col("bpm").cast("double")).alias("_c_b"),
                     F.when(text.not_missing("mode"), F.col("mode").cast("string")).alias("_c_m"))
    return (providers.join(c, key, "full")
            .withColumn("_c_present", F.coalesce(F.col("_c_present"), F.lit(False))))


def enrich_chain(tracks: DataFrame, providers: DataFrame, cache: DataFrame | None = None,
                 key: str = "song_key", bpm: str = "bpm", mode: str = "mode") -> DataFrame:
    """Row-independent chain: own -> cache -> p1..p4 per attribute, with
    per-attribute provenance.  ``providers`` from parse_providers;
    ``cache``: key, bpm, mode.  Replaces bpm/mode, adds bpm_source and
    mode_source (an own value has no source)."""
    t = _own(tracks, bpm, mode)
    j = lookup_join(t, _lookups(providers, cache, key), [key], "left")
    pb, pm = _provider_values(j)
    in_c = F.coalesce(F.col("_c_present"), F.lit(False))
    b, bl = _chain([(F.col("_own_b"), None), (F.when(in_c, F.col("_c_b")), C.CACHE_LABEL)] + pb)
    m, ml = _chain([(F.col("_own_m"), None), (F.when(in_c, F.col("_c_m")), C.CACHE_LABEL)] + pm)
    out = j.withColumns({bpm: b.cast("double"), mode: m, "bpm_source": bl, "mode_source": ml})
    return out.drop(*[c for c in out.columns if c.startswith("_") and c not in tracks.columns],
                    "p1_bpm", "p2_bpm", "p2_mode", "p3_bpm", "p3_mode", "p4_bpm", "p4_mode",
                    "p2_bpm_by", "p2_mode_by", "p4_bpm_by", "p4_mode_by")


# ---------------------------------------------------------------------------
# Order-dependent fold (JOI-8)
# ---------------------------------------------------------------------------

def _cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder and continue from
    the written data (lineage cut that survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def prior_last(df: DataFrame, key: str, order: str, values: dict[str, str],
               chunk_rows: int | None = None) -> DataFrame:
    """For each row and each ``values`` entry {out: col}: the last non-NULL
    ``col`` among earlier rows of the same key (strictly smaller
    ``order``): a scan in levels of bounded windows."""
    return before(df, key, order, {o: ("last", c) for o, c in values.items()}, chunk_rows)


def enrich_fold(tracks: DataFrame, providers: DataFrame, cache: DataFrame | None = None,
                key: str = "song_key", order: str = "_row", bpm: str = "bpm", mode: str = "mode",
                chunk_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(enriched rows, cache snapshot after the batch) with in-batch reuse.

    ``tracks``: key, ``order`` (unique), own bpm/mode.  ``providers``: per
    key p*_bpm/p*_mode (parse_providers).  ``cache``: key, bpm, mode."""
    # only key, order and the two values go through the fold; the rest joins at the end
    t = _own(tracks.select(key, order, bpm, mode), bpm, mode)
    lk = _lookups(providers, cache, key)
    pbl, pml = _provider_values(lk)
    pb, pb_lab = _chain(pbl)
    pm, pm_lab = _chain(pml)
    lk = lk.select(key, "_c_present", "_c_b", "_c_m", pb.alias("_pb"), pb_lab.alias("_pb_lab"),
                   pm.alias("_pm"), pm_lab.alias("_pm_lab"))
    j = lookup_join(t, lk, [key], "left").withColumn(
        "_c_present", F.coalesce(F.col("_c_present"), F.lit(False)))
    ob, om = F.col("_own_b").isNotNull(), F.col("_own_m").isNotNull()
    hb, hm = F.col("_pb").isNotNull(), F.col("_pm").isNotNull()
    a_b = ~ob & hb                                    # b turns non-NULL whatever m is
    a_m = ~om & hm
    b_b = ob & ~om                                    # b turns non-NULL only while m is NULL
    b_m = om & ~ob
    j = j.withColumns({"_a_b": a_b, "_a_m": a_m, "_flip_b": a_b | b_b, "_flip_m": a_m | b_m})
    # The row frame feeds several per-key aggregates and their join-backs:
    # cut its lineage once (reliable checkpoint in the shared folder) so the
    # scan and lookup join are not recomputed for every branch.
    j = _cut(j.select(key, order, *[c for c in t.columns if c not in (key, order)],
                      *[c for c in j.columns if c.startswith("_") and c not in t.columns]))

    # Pass 1: first row of each key (an absent key's first row always writes).
    first = j.groupBy(key).agg(F.min(order).alias("_first"),
                               F.min_by(F.struct(ob.alias("ob"), om.alias("om")), F.col(order)).alias("_r1"))
    j = lookup_join(j, first, [key], "left")
    absent = ~F.col("_c_present")
    is_first = F.col(order) == F.col("_first")
    in_phase = F.col("_c_present") | ~is_first       # rows processed with a present state
    # Null-pattern of the state when the present phase starts.
    j = j.withColumns({
        "_nb0": F.when(absent, F.col("_r1.ob") | hb).otherwise(F.col("_c_b").isNotNull()),
        "_nm0": F.when(absent, F.col("_r1.om") | hm).otherwise(F.col("_c_m").isNotNull()),
        "_in_phase": in_phase,
    })
    # Pass 2: first rows, inside the present phase, where an attribute can turn non-NULL.
    ph = F.col("_in_phase")
    c1 = F.col("_flip_b") | F.col("_flip_m")
    t_agg = j.groupBy(key).agg(
        F.min_by(F.struct(F.col(order).alias("r"), F.col("_flip_b").alias("fb"), F.col("_flip_m").alias("fm")),
                 F.when(ph & c1, F.col(order))).alias("_t1"),
        F.min(F.when(ph & F.col("_a_b"), F.col(order))).alias("_tab"),
        F.min(F.when(ph & F.col("_a_m"), F.col(order))).alias("_tam"))
    j = lookup_join(j, t_agg, [key], "left")
    nb0, nm0 = F.col("_nb0"), F.col("_nm0")
    t1 = F.col("_t1.r")
    inf = F.lit(None).cast("bigint")
    # Row at which each attribute of the state turns non-NULL (NULL = never).
    tb = (F.when(nb0, inf)
          .when(nm0, F.col("_tab"))                                    # phase (0,1)
          .when(F.col("_t1.fb"), t1)                                   # phase (0,0), b flips at T1
          .when(F.col("_t1.fm"), F.col("_tab")))                       # m flipped first
    tm = (F.when(nm0, inf)
          .when(nb0, F.col("_tam"))
          .when(F.col("_t1.fm"), t1)
          .when(F.col("_t1.fb"), F.col("_tam")))
    o = F.col(order)
    nb = nb0 | (tb.isNotNull() & (tb < o))            # state bits before this row
    nm = nm0 | (tm.isNotNull() & (tm < o))
    absent_first = absent & is_first
    writing = absent_first | (ph & ((~ob & ~nb) | (~om & ~nm)))
    j = j.withColumns({
        "_wb": F.when(writing & (ob | ~nb | absent_first), F.coalesce(F.col("_own_b"), F.col("_pb"))),
        "_wm": F.when(writing & (om | ~nm | absent_first), F.coalesce(F.col("_own_m"), F.col("_pm"))),
    })
    j = prior_last(j, key, order, {"_sb": "_wb", "_sm": "_wm"}, chunk_rows)
    # State values before this row: latest write, else the initial cache entry.
    st_b = F.when(F.col("_c_present") | ~is_first, F.coalesce(F.col("_sb"), F.col("_c_b")))
    st_m = F.when(F.col("_c_present") | ~is_first, F.coalesce(F.col("_sm"), F.col("_c_m")))
    b, bl = _chain([(F.col("_own_b"), None), (st_b, C.CACHE_LABEL), (F.col("_pb"), None)])
    m, ml = _chain([(F.col("_own_m"), None), (st_m, C.CACHE_LABEL), (F.col("_pm"), None)])
    bl = F.when(F.col("_own_b").isNull() & st_b.isNull(), F.col("_pb_lab")).otherwise(bl)
    ml = F.when(F.col("_own_m").isNull() & st_m.isNull(), F.col("_pm_lab")).otherwise(ml)
    out = j.withColumns({bpm: b.cast("double"), mode: m, "bpm_source": bl, "mode_source": ml})
    keep = [c for c in tracks.columns if c not in (bpm, mode)] + [bpm, mode, "bpm_source", "mode_source"]
    rest = [c for c in tracks.columns if c not in (key, order, bpm, mode)]
    rows = out.select(key, order, bpm, mode, "bpm_source", "mode_source")
    if rest:
        rows = rows.join(tracks.select(order, *rest), order)
    rows = rows.select(*keep)

    # Cache after the batch: last write per key, else the initial entry.
    wrote = j.groupBy(key).agg(
        F.max_by(F.col("_wb"), F.when(F.col("_wb").isNotNull(), F.col(order))).alias("_lb"),
        F.max_by(F.col("_wm"), F.when(F.col("_wm").isNotNull(), F.col(order))).alias("_lm"),
        F.max(F.when(absent_first, F.lit(True))).alias("_new_key"))
    snap = lk.join(wrote, key, "full").where(F.col("_c_present") | F.col("_new_key"))
    snap = snap.select(key, F.coalesce("_lb", "_c_b").alias("bpm"), F.coalesce("_lm", "_c_m").alias("mode"))
    return rows, snap
