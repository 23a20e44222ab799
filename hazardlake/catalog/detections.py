"""Profile tables of the historical detections."""

from __future__ import annotations


from hazardlake.catalog.fixtures import BOX, REGION
from hazardlake.catalog.registry import query
from hazardlake.operators import detections as ops, stats
from hazardlake.operators.detections import in_country

MONTH_LABELS = ("Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez")
LABEL = "['" + "','".join(MONTH_LABELS) + "'][mes]"


def archive(t):
    return in_country(t.archive)


def box_sql(rows: str, group: str, value: str) -> str:
    """Box statistics of ``value`` per ``group`` over a table expression."""
    return f"""WITH r AS (SELECT {group} AS g, {value} AS v FROM {rows} WHERE {group} IS NOT NULL AND {value} IS NOT NULL),
 f AS (SELECT g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS m, quantile_cont(v, 0.75) AS q3 FROM r GROUP BY g),
 x AS (SELECT r.*, q1, m, q3, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM r JOIN f ON r.g = f.g)
SELECT g AS {group}, count(*) AS n, round(q1, 6) AS q1, round(m, 6) AS median, round(q3, 6) AS q3,
 round(least(q1, min(v) FILTER (inside)), 6) AS whisker_low, round(greatest(q3, max(v) FILTER (inside)), 6) AS whisker_high,
 count(*) FILTER (NOT inside) AS outliers FROM x GROUP BY g, q1, m, q3"""


def corr_sql(table: str, columns) -> str:
    """Lower triangle of the correlation matrix; a constant column has no coefficient."""
    pairs = [(columns[j], columns[i]) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, CASE WHEN min(CASE WHEN {b} IS NOT NULL THEN {a} END) "
        f"< max(CASE WHEN {b} IS NOT NULL THEN {a} END) AND min(CASE WHEN {a} IS NOT NULL THEN {b} END) "
        f"< max(CASE WHEN {a} IS NOT NULL THEN {b} END) THEN round(corr({a}, {b}), 6) END AS r FROM {table}"
        for a, b in pairs)


def describe_sql(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std, "
        f"round(min({c}), 2) AS min, round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50, "
        f"round(quantile_cont({c}, 0.75), 2) AS p75, round(max({c}), 2) AS max FROM {table}" for c in columns)


def nulls_sql(table: str, columns) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, count(*) AS n FROM {table}" for c in columns)
    return (f"WITH cells AS ({cells}) SELECT column_name, nulls, round(nulls * 100.0 / greatest(n, 1), 2) AS null_pct "
            f"FROM cells UNION ALL SELECT 'TOTAL', CAST(sum(nulls) AS BIGINT), NULL FROM cells")


# --- counts and means ----------------------------------------------------------------

@query("agg_05", "SELECT ano, count(*) AS hotspots FROM fx_arch_kept GROUP BY ano")
def per_year(t):
    return ops.per_year(archive(t))


@query("agg_06", "SELECT ano, round(avg(frp), 6) AS frp_medio FROM fx_arch_kept GROUP BY ano")
def frp_per_year(t):
    return ops.frp_per_year(archive(t))


@query("agg_07", """SELECT m.mes, count(k.event_id) AS hotspots FROM fx_months m LEFT JOIN fx_kept k ON m.mes = k.mes
 GROUP BY m.mes""")
def per_month(t):
    return ops.per_month(t.kept)


@query("agg_08", "SELECT ano, " + ", ".join(
    f"count(*) FILTER (mes = {i}) AS {label}" for i, label in enumerate(MONTH_LABELS, 1)) + " FROM fx_arch_kept GROUP BY ano")
def year_month(t):
    return ops.year_month_matrix(archive(t))


@query("agg_09", """SELECT CASE WHEN mes BETWEEN 6 AND 9 THEN 'Verão (Jun–Set)' ELSE 'Resto do ano' END AS epoca,
 count(*) AS hotspots FROM fx_arch_kept GROUP BY 1""")
def per_season(t):
    return ops.per_season(archive(t))


@query("agg_10", f"SELECT {REGION} AS regiao, count(*) AS hotspots FROM fx_kept GROUP BY 1")
def per_region(t):
    return ops.per_region(t.kept)


@query("agg_11", f"SELECT {REGION} AS regiao, round(avg(frp), 6) AS frp_medio FROM fx_kept GROUP BY 1")
def frp_per_region(t):
    return ops.frp_per_region(t.kept)


@query("agg_16", """SELECT satelite, count(*) AS hotspots, round(count(*) * 100.0 / (SELECT count(*) FROM fx_kept), 1) AS pct
FROM fx_kept GROUP BY satelite""")
def satellite_share(t):
    return ops.satellite_share(t.kept)


@query("agg_17", "SELECT ano, " + ", ".join(
    f"round(avg(frp) FILTER (satelite = '{s}'), 6) AS \"{s}\"" for s in ("VIIRS S-NPP", "VIIRS NOAA-20", "VIIRS"))
    + " FROM fx_arch_kept GROUP BY ano")
def frp_year_satellite(t):
    return ops.frp_year_satellite(archive(t))


@query("agg_29", """SELECT round(latitude, 2) AS latitude, round(longitude, 2) AS longitude, count(*) AS hotspots,
 round(avg(frp), 6) AS frp_medio FROM fx_arch_kept GROUP BY 1, 2""")
def density(t):
    return ops.density(archive(t))


# --- distribution of radiative power ---------------------------------------------------------

@query("agg_12", """WITH c AS (SELECT least(frp, (SELECT quantile_cont(frp, 0.99) FROM fx_kept)) AS v FROM fx_kept
 WHERE frp IS NOT NULL), lim AS (SELECT min(v) AS lo, max(v) AS hi FROM c)
SELECT CAST(b AS INT) AS bin, round(lo + (hi - lo) / 60 * b, 6) AS lower, round(lo + (hi - lo) / 60 * (b + 1), 6) AS upper,
 (SELECT count(*) FROM c WHERE least(59, floor((v - lo) / (hi - lo) * 60)) = b) AS n,
 round((SELECT quantile_cont(frp, 0.5) FROM fx_kept), 6) AS mediana FROM lim, generate_series(0, 59) g(b)""")
def frp_histogram(t):
    return ops.frp_histogram(t.kept)


@query("agg_13", box_sql(f"(SELECT frp, {LABEL} AS mes_l FROM fx_arch_kept WHERE mes BETWEEN 5 AND 10)", "mes_l", "frp"))
def frp_by_month(t):
    return ops.frp_by_month(archive(t))


@query("agg_14", box_sql("(SELECT frp, CASE daynight WHEN 'D' THEN 'Diurno' WHEN 'N' THEN 'Noturno' END AS periodo FROM fx_kept)",
                         "periodo", "frp"))
def frp_by_period(t):
    return ops.frp_by_period(t.kept)


@query("agg_15", "SELECT round(quantile_cont(frp, 0.95), 6) AS p95 FROM fx_arch_kept")
def frp_axis_cap(t):
    return ops.frp_axis_cap(archive(t))


@query("agg_23", """SELECT round(median(frp), 1) AS frp_mediana, round(avg(frp), 1) AS frp_media, round(max(frp), 1) AS frp_max
FROM fx_kept""")
def frp_summary(t):
    return ops.frp_summary(t.kept)


@query("agg_24", """WITH q AS (SELECT quantile_cont(frp, 0.25) AS q1, quantile_cont(frp, 0.75) AS q3 FROM fx_kept)
SELECT count(*) FILTER (frp > q3 + 3 * (q3 - q1)) AS frp_outliers FROM fx_kept, q""")
def frp_outliers(t):
    return ops.frp_outliers(t.kept)


# --- whole-table figures ----------------------------------------------------------------------

CORRELATED = ("latitude", "longitude", "bright_ti4", "bright_ti5", "frp", "mes", "ano")


@query("agg_18", corr_sql("fx_kept", CORRELATED))
def correlations(t):
    return ops.correlations(t.kept)


@query("agg_19", describe_sql("fx_kept", CORRELATED[:5]))
def describe(t):
    return ops.describe(t.kept)


@query("agg_20", f"""SELECT count(*) AS total_raw, count(*) FILTER ({BOX}) AS total_pt,
 count(*) FILTER (NOT ({BOX})) AS fora_bbox, min(acq_date) FILTER ({BOX}) AS periodo_ini,
 max(acq_date) FILTER ({BOX}) AS periodo_fim,
 (SELECT string_agg(CAST(ano AS STRING), ',' ORDER BY ano) FROM (SELECT DISTINCT ano FROM fx_arch_kept)) AS anos,
 (SELECT string_agg(satelite, ',' ORDER BY satelite) FROM (SELECT DISTINCT satelite FROM fx_arch_kept)) AS satelites,
 12 AS colunas FROM fx_arch""")
def profile(t):
    return ops.profile(t.archive)


@query("agg_21", nulls_sql("fx_kept", ("latitude", "longitude", "bright_ti4", "bright_ti5", "frp", "confidence", "daynight")))
def nulls(t):
    return stats.null_profile(t.kept, ("latitude", "longitude", "bright_ti4", "bright_ti5", "frp", "confidence", "daynight"))


DUPLICATES = """SELECT CAST(d AS BIGINT) AS duplicates, round(d * 100.0 / n, 2) AS duplicates_pct FROM (SELECT
 (SELECT count(*) FROM fx_hotspot_dup) AS n, (SELECT count(*) FROM fx_hotspot_dup)
 - (SELECT count(*) FROM (SELECT DISTINCT * FROM fx_hotspot_dup)) AS d)"""


@query("agg_22", DUPLICATES)
def duplicates(t):
    return stats.duplicate_rows(t.hotspot_dup)


@query("agg_25", f"SELECT {LABEL} AS mes_pico, count(*) AS hotspots FROM fx_arch_kept GROUP BY mes ORDER BY hotspots DESC, mes LIMIT 1")
def peak_month(t):
    return ops.peak_month(archive(t))


@query("agg_26", "SELECT round(count(*) FILTER (mes BETWEEN 7 AND 10) * 100.0 / count(*), 1) AS pct_verao FROM fx_arch_kept")
def high_season_share(t):
    return ops.high_season_share(archive(t))


@query("agg_27", f"SELECT {REGION} AS regiao_top, count(*) AS hotspots FROM fx_kept GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def top_region(t):
    return ops.top_region(t.kept)


@query("agg_28", f"SELECT round(count(*) FILTER (NOT ({BOX})) * 100.0 / count(*), 2) AS fora_pct FROM fx_hotspot")
def outside_share(t):
    return ops.outside_share(t.hotspot)
