"""Windows, ranks, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark.functions.dates import iso_date
from leadspark.functions.hashing import hash32_sql
from leadspark.operators import metrics as M
from leadspark.operators import ranking as R
from leadspark.operators import splits
from leadspark.plans.frames import CURRENT_SQL, PANEL_SQL, SCORE_SQL, SCORED_SQL, current, panel, scored, with_demo_score
from leadspark.registry import query

RANKED = "WITH " + SCORED_SQL + ", ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, row_key) AS rank, count(*) OVER () AS n FROM scored)"
DECILE = "CASE WHEN n <= 1 THEN 1 ELSE greatest(1, ((rank - 1) * 10 + n - 2) // (n - 1)) END"


def _key():
    return F.col("row_key")


@query("win_rank_first", RANKED + "SELECT row_key, score, rank FROM ranked")
def win_rank_first(spark, sf):
    return R.with_rank(scored(spark, sf), -F.col("score"), _key()).select("row_key", "score", "rank")


LEADS_SQL = "WITH " + CURRENT_SQL + f""", s AS (SELECT company_id, company_name, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, CAST({SCORE_SQL} AS DOUBLE) AS p_convert FROM prospects),
ranked AS (SELECT *, row_number() OVER (ORDER BY p_convert DESC, company_id) AS rank, count(*) OVER () AS n FROM s)"""


def _leads(spark, sf):
    s = with_demo_score(current(spark, sf))
    return s.select("company_id", "company_name", iso_date(F.col("snapshot_date")).alias("snapshot_date"), F.col("score").alias("p_convert"))


@query("win_rank_leads", LEADS_SQL + "SELECT company_id, p_convert, rank FROM ranked")
def win_rank_leads(spark, sf):
    return R.rank_leads(_leads(spark, sf)).select("company_id", "p_convert", "rank")


@query("scr_leads", LEADS_SQL + f"SELECT company_id, company_name, snapshot_date, p_convert, rank, CAST({DECILE} AS BIGINT) AS decile FROM ranked")
def scr_leads(spark, sf):
    return R.rank_leads(_leads(spark, sf))


@query("win_qcut", RANKED + f"SELECT row_key, CAST({DECILE} AS BIGINT) AS decile FROM ranked")
def win_qcut(spark, sf):
    return M.with_deciles(scored(spark, sf), "score", "row_key").select("row_key", "decile")


@query("win_rank_avg", "WITH " + SCORED_SQL + """SELECT row_key, round((rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0) / count(*) OVER (), 6) AS p_rank FROM scored""")
def win_rank_avg(spark, sf):
    return R.average_rank_share(scored(spark, sf), "score").select("row_key", F.round("p_rank", 6).alias("p_rank"))


@query("win_cumsum", RANKED + "SELECT row_key, rank, CAST(sum(target) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_positives FROM ranked")
def win_cumsum(spark, sf):
    sums = {"rank": F.lit(1).cast("long"), "cum_positives": F.col("target").cast("long")}
    return R.running_sums(scored(spark, sf), -F.col("score"), _key(), sums).select("row_key", "rank", "cum_positives")


@query(
    "win_per_stratum",
    "WITH " + PANEL_SQL + f""", r AS (SELECT row_key, canton, target, row_number() OVER (PARTITION BY canton, target ORDER BY {hash32_sql('row_key')}, row_key) AS r FROM panel)
SELECT row_key, canton, CAST(target AS BIGINT) AS target FROM r WHERE r <= 5""",
)
def win_per_stratum(spark, sf):
    df = panel(spark, sf).select("row_key", "canton", "target")
    quotas = df.select("canton", "target").distinct().withColumn("quota", F.lit(5))
    return R.hash_quota(df, _key(), 42, ["canton", "target"], quotas).withColumn("target", F.col("target").cast("long"))


@query(
    "win_fold_position",
    "WITH " + PANEL_SQL + "SELECT row_key, row_number() OVER (ORDER BY snapshot_date, company_id) - 1 AS position FROM panel",
)
def win_fold_position(spark, sf):
    df = panel(spark, sf).select("row_key", "company_id", "snapshot_date")
    return splits.with_position(df).select("row_key", "position")


@query("srt_chrono", "WITH " + PANEL_SQL + "SELECT strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, company_id, CAST(target AS BIGINT) AS target FROM panel ORDER BY snapshot_date, company_id")
def srt_chrono(spark, sf):
    df = splits.chronological(panel(spark, sf).select("snapshot_date", "company_id", "target"))
    return df.select(iso_date(F.col("snapshot_date")).alias("snapshot_date"), "company_id", F.col("target").cast("long").alias("target"))


@query(
    "lim_head",
    "WITH " + PANEL_SQL + """SELECT row_key, canton FROM panel
WHERE target = 1 AND canton NOT IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4') ORDER BY snapshot_date, row_key LIMIT 1000""",
)
def lim_head(spark, sf):
    """The first 1000 positives outside the big cantons."""
    from leadspark.operators.sampling import preserved_positives
    from leadspark.plans.frames import BIG_CANTONS

    rows = panel(spark, sf).select("row_key", "canton", "target", "snapshot_date")  # without a size class only cantons decide
    return preserved_positives(rows, big_cantons=tuple(BIG_CANTONS), limit=1000).select("row_key", "canton")


@query("topk_scores", RANKED + "SELECT row_key, score, CAST(target AS BIGINT) AS target FROM ranked WHERE rank <= 1000")
def topk_scores(spark, sf):
    df = scored(spark, sf).select("row_key", "score", F.col("target").cast("long").alias("target"))
    return R.top_k(df, "score", "row_key", 1000)


@query("topk_threshold", RANKED + "SELECT coalesce(min(score), 1.0) AS threshold FROM ranked WHERE rank <= 1000")
def topk_threshold(spark, sf):
    return M.top_k_threshold(scored(spark, sf), 1000)
