"""Declared rollups and the batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.catalogue.base import query
from lexweave.catalogue.scans import project_types
from lexweave.config.standard_model import standard_mapping
from lexweave.config.whitelists import lead_whitelist
from lexweave.fixtures import ORG, Tables
from lexweave.plans import jobs, marts
from lexweave.sources.files import union_all

query("a5_posts_by_date", """
    SELECT CAST(PostDate AS DATE) AS Date_Date, count(*) AS Posts,
      CAST(sum(Comments) AS BIGINT) AS Comments, CAST(sum(Likes) AS BIGINT) AS Likes
    FROM {posts} GROUP BY 1""")(lambda t: marts.posts_by_date(t.posts()))

query("a6_posts_by_hashtag", r"""
    SELECT Hashtag, Hashtag_Date, count(*) AS Posts FROM (
      SELECT unnest(list_distinct(regexp_extract_all(Caption, '#(\w+)', 1))) AS Hashtag,
        CAST(PostDate AS DATE) AS Hashtag_Date FROM {posts})
    GROUP BY 1, 2""")(lambda t: marts.posts_by_hashtag(t.posts()))

query("a7_posts_by_media_type", """
    SELECT Media_Type, CAST(PostDate AS DATE) AS Media_Type_Date, count(*) AS Posts
    FROM {posts} GROUP BY 1, 2""")(lambda t: marts.posts_by_media_type(t.posts()))

query("a7_posts_by_hour", """
    SELECT CAST(hour(PostDate) AS INT) AS Hour, CAST(PostDate AS DATE) AS Hours_Date,
      count(*) AS Posts FROM {posts} GROUP BY 1, 2""")(lambda t: marts.posts_by_hour(t.posts()))

@query("a8_case_value_cluster_order", """
    SELECT k, (SELECT count(DISTINCT o_totalprice) FROM orders) AS n_values, k AS n_labels, true AS ascending,
      true AS within_bounds
    FROM (SELECT unnest([2, 3, 4, 5, 6, 7]) AS k)""")
def cluster_order(t: Tables) -> DataFrame:
    """What holds for the clusters of any fit: every value once, labels that ascend with it, bounds around it."""
    out = marts.case_value_clusters(t["orders"], "o_totalprice")
    value = F.col("final_value")
    inside = value.between(F.col("clusters_lower_bound"), F.col("clusters_upper_bound"))
    rows = []
    for k in range(2, 8):
        label = f"clusters_{k}"
        ends = out.groupBy(label).agg(
            F.min("final_value").alias("low"), F.max("final_value").alias("high"),
            F.count(F.lit(1)).alias("n"), F.min(inside).alias("inside"))
        # At most seven rows from here on.
        ordered = F.sort_array(F.collect_list(F.struct(label, "low", "high")))
        apart = F.forall(
            F.sequence(F.lit(1), F.size("o") - 1),
            lambda i: F.get("o", i)["low"] > F.get("o", i - 1)["high"])
        rows.append(ends.agg(ordered.alias("o"), F.sum("n").alias("n"), F.min("inside").alias("inside")).select(
            F.lit(k).alias("k"), F.col("n").alias("n_values"), F.size("o").cast("bigint").alias("n_labels"),
            apart.alias("ascending"), F.col("inside").alias("within_bounds")))
    return union_all(rows)


def clusters_sql(most: int) -> str:
    """Least-cost clusters by the same recurrence: the best k of the first bins from the best k - 1 of fewer."""
    steps = [
        "d0 AS (SELECT CAST(0 AS BIGINT) AS j, CAST(0 AS DOUBLE) AS cost, CAST(0 AS BIGINT) AS i)"
    ]
    for k in range(1, most + 1):
        steps.append(f"""d{k} AS MATERIALIZED (
            SELECT j, best.cost AS cost, best.i AS i FROM (
              SELECT b.j, min({{'cost': d.cost + ((b.q - a.q) - (b.s - a.s) * (b.s - a.s) / (b.n - a.n)), 'i': a.j}}) AS best
              FROM d{k - 1} d JOIN sums a ON a.j = d.j JOIN sums b ON b.j > a.j GROUP BY b.j))""")
    chains, labels = [], []
    for k in range(2, most + 1):
        at = "(SELECT max(j) FROM sums)"
        starts = []
        for step in range(k, 1, -1):
            chains.append(f"c{k}_{step} AS (SELECT i FROM d{step} WHERE j = {at})")
            at = f"(SELECT i FROM c{k}_{step})"
            starts.append(f"CAST(bin >= (SELECT bin FROM sums WHERE j = {at} + 1) AS INT)")
        labels.append(f"{' + '.join(starts)} AS clusters_{k}")
    return f"""
    WITH v AS (SELECT o_totalprice AS final_value, count(*) AS w FROM orders GROUP BY 1),
      e AS (SELECT min(final_value) AS low, max(final_value) - min(final_value) AS wide FROM v),
      p AS (SELECT final_value, w, CAST(floor((final_value - low) / wide * 1048575.0::DOUBLE) AS BIGINT) AS place FROM v, e),
      h AS (SELECT place // 1024 AS bin FROM p GROUP BY 1 HAVING sum(w) * 64 > (SELECT sum(w) FROM p)),
      x AS (SELECT *, CASE WHEN place // 1024 IN (SELECT bin FROM h) THEN place // 16 ELSE place // 1024 * 64 END AS bin FROM p),
      g AS (SELECT bin, sum(w) AS n, sum(w * place) AS s, sum(w * place * place) AS q FROM x GROUP BY 1),
      sums AS MATERIALIZED (
        SELECT bin, row_number() OVER (ORDER BY bin) AS j, CAST(sum(n) OVER (ORDER BY bin) AS DOUBLE) AS n,
          CAST(sum(s) OVER (ORDER BY bin) AS DOUBLE) AS s, CAST(sum(q) OVER (ORDER BY bin) AS DOUBLE) AS q FROM g
        UNION ALL SELECT NULL, 0, 0, 0, 0),
      {", ".join(steps)}, {", ".join(chains)},
      l AS (SELECT final_value, {", ".join(labels)} FROM x)
    SELECT *, CAST(floor(min(final_value) OVER (PARTITION BY clusters_{most})) AS INT) AS clusters_lower_bound,
      CAST(ceil(max(final_value) OVER (PARTITION BY clusters_{most})) AS INT) AS clusters_upper_bound FROM l"""


query("a8_case_value_clusters", clusters_sql(7))(
    lambda t: marts.case_value_clusters(t["orders"], "o_totalprice"))


def targets_and_actuals(t: Tables) -> tuple[DataFrame, DataFrame]:
    periods = marts.period_columns(F.to_date("o_orderdate"))
    rows = t["orders"].select(
        (F.col("o_custkey") % 10).alias("Team_member_id"), "o_orderkey",
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        *[c.alias(n) for n, c in periods.items()],
    )
    goals = rows.where("o_orderkey % 2 = 0").withColumn(
        "Target", (F.col("amount") * 2).cast("decimal(12,2)"))
    return goals, rows


GRAIN_SQL: list[str] = []

for grain, keys in marts.GRAINS.items():
    PERIODS = {
        "Year": "year(o_orderdate)", "Quarter": "quarter(o_orderdate)",
        "Month": "month(o_orderdate)", "Week": "week(o_orderdate)",
    }
    names = ", ".join(keys)
    query(f"a9_targets_by_{grain}", f"""
        WITH r AS (SELECT o_custkey % 10 AS Team_member_id, o_orderkey,
            CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
            {", ".join(f"CAST({PERIODS[k]} AS INT) AS {k}" for k in keys)} FROM orders),
          g AS (SELECT Team_member_id, {names}, sum(amount * 2) AS target FROM r
            WHERE o_orderkey % 2 = 0 GROUP BY ALL),
          d AS (SELECT Team_member_id, {names}, sum(amount) AS actual FROM r GROUP BY ALL)
        SELECT Team_member_id, {names}, CAST(target AS DOUBLE) AS target,
          CAST(coalesce(actual, 0) AS DOUBLE) AS actual, coalesce(actual, 0) >= target AS attained
        FROM g LEFT JOIN d USING (Team_member_id, {names})""")(
        lambda t, grain=grain: marts.target_attainment(*targets_and_actuals(t), grain)
        .withColumns({n: F.col(n).cast("double") for n in ("target", "actual")}))
    GRAIN_SQL.append(f"""
        SELECT '{grain}' AS grain, Team_member_id, {", ".join(k if k in keys else f"CAST(NULL AS INT) AS {k}" for k in PERIODS)},
          CAST(sum(amount * 2) FILTER (o_orderkey % 2 = 0) AS DOUBLE) AS target, CAST(sum(amount) AS DOUBLE) AS actual,
          sum(amount) >= sum(amount * 2) FILTER (o_orderkey % 2 = 0) AS attained
        FROM r GROUP BY Team_member_id, {names} HAVING count(*) FILTER (o_orderkey % 2 = 0) > 0""")


@query("a9_targets_in_one_pass", f"""
    WITH r AS (SELECT o_custkey % 10 AS Team_member_id, o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
      {", ".join(f"CAST({v} AS INT) AS {k}" for k, v in PERIODS.items())} FROM orders)
    {" UNION ALL ".join(GRAIN_SQL)}""")
def targets_in_one_pass(t: Tables) -> DataFrame:
    facts = targets_and_actuals(t)[1].withColumn(
        "Target", F.when(F.col("o_orderkey") % 2 == 0, (F.col("amount") * 2).cast("decimal(12,2)")))
    return marts.attainment_by_grain(facts).withColumns({n: F.col(n).cast("double") for n in ("target", "actual")})


ROLLUPS_SQL = """
    WITH p AS (SELECT CAST(PostDate AS DATE) AS day, * FROM {{posts}} {where})
    SELECT 'date' AS rollup, CAST(NULL AS VARCHAR) AS key, day, count(*) AS Posts,
      CAST(sum(Comments) AS BIGINT) AS Comments, CAST(sum(Likes) AS BIGINT) AS Likes FROM p GROUP BY day
    UNION ALL SELECT 'media_type', Media_Type, day, count(*), CAST(sum(Comments) AS BIGINT),
      CAST(sum(Likes) AS BIGINT) FROM p GROUP BY Media_Type, day
    UNION ALL SELECT 'hour', CAST(hour(PostDate) AS VARCHAR), day, count(*), CAST(sum(Comments) AS BIGINT),
      CAST(sum(Likes) AS BIGINT) FROM p GROUP BY hour(PostDate), day
    UNION ALL SELECT 'hashtag', tag, day, count(*), CAST(sum(Comments) AS BIGINT), CAST(sum(Likes) AS BIGINT)
      FROM (SELECT unnest(list_distinct(regexp_extract_all(Caption, '#(\\w+)', 1))) AS tag, * FROM p) GROUP BY tag, day"""

query("a5_rollups_in_one_pass", ROLLUPS_SQL.format(where=""))(lambda t: marts.post_rollups(t.posts()))


@query("a5_rollups_after_updates", ROLLUPS_SQL.format(where=""))
def rollups_after_updates(t: Tables) -> DataFrame:
    """A third of the posts was rolled up under another day, type and caption, and is corrected by its changes."""
    posts = t.posts()
    third = F.col("Likes") % 3 == 0
    old = posts.where(third).withColumns({
        "PostDate": F.col("PostDate") - F.expr("INTERVAL 30 HOURS"), "Media_Type": F.lit("draft"),
        "Caption": F.concat("Caption", F.lit(" #draft")), "Comments": F.col("Comments") + 1,
    })
    stored = marts.post_rollups(posts.where(~third).unionByName(old))
    return marts.merge_rollups(stored, marts.post_changes(old, posts.where(third)))


# Jobs ---------------------------------------------------------------------


def row_counts(t: Tables, paths: dict[str, str]) -> DataFrame:
    """Rows of every written table."""
    return union_all([
        t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows")
        for name, path in paths.items()
    ])


@query("t14_lead_load", """
    SELECT 'statuses' AS table_name, count(*) AS n_rows FROM region
    UNION ALL SELECT 'leadsource', count(*) FROM nation
    UNION ALL SELECT 'casetype', count(*) FROM part
    UNION ALL SELECT 'leadrow', count(*) FROM orders
    UNION ALL SELECT 'leaddetail', count(*) FROM orders
    UNION ALL SELECT 'contact', count(*) FROM customer
    UNION ALL SELECT 'opportunities', count(*) FROM orders WHERE o_orderkey % 4 <> 0
    UNION ALL SELECT 'referrals', count(*) FROM nation
    UNION ALL SELECT 'users', count(*) FROM supplier""")
def lead_load(t: Tables) -> DataFrame:
    paths = jobs.load_leads(t.landed_leads(), lead_whitelist("acme"), t.scratch("lead"))
    return row_counts(t, paths)


@query("t14_lead_load_details", """
    SELECT o_orderkey AS Id, o_orderstatus AS Status, o_custkey AS Contact FROM orders""")
def lead_load_details(t: Tables) -> DataFrame:
    """What the load stored of the lead details, not only how many."""
    landed = {"leaddetail": t.raw_lead_details()}
    paths = jobs.load_leads(landed, lead_whitelist("acme"), t.scratch("lead"))
    return t.spark.read.parquet(paths["leaddetail"]).select("Id", "Status", "Contact")


@query("t15_case_load", """
    SELECT 'contact' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'projecttype', count(DISTINCT projectTypeId) FROM {phase_dim}
    UNION ALL SELECT 'project', count(*) FROM orders
    UNION ALL SELECT 'intake', count(*) FROM orders
    UNION ALL SELECT 'meds', count(*) FROM lineitem""")
def case_load(t: Tables) -> DataFrame:
    landed = {
        "contact": t.raw_contacts(),
        "projecttype": project_types(t),
        "project": t.raw_projects(),
        "intake": t["intake"],
        "meds": t["meds"],
    }
    types = {
        "contact": {"personId": "Id", "firstName": "Text", "personTypes": "StringList"},
        "project": {"projectId": "Id", "projectTypeId": "Id", "hashtags": "StringList"},
        "intake": {"projectId": "ProjectId", "dateofintake": "Date", "referralfee": "Currency"},
        "meds": {"projectId": "ProjectId", "id": "Id", "type": "Dropdown", "valueTotal": "decimal"},
    }
    return row_counts(t, jobs.load_cases(landed, types, t.scratch("case")))


@query("t16_standard_model_run", """
    SELECT 'PeopleTypes' AS table_name, count(DISTINCT token) AS n_rows FROM (
      SELECT unnest(string_split(personTypes, '|')) AS token FROM {contact}) WHERE token <> ''
    UNION ALL SELECT 'Peoples', count(*) FROM {contact}
    UNION ALL SELECT 'Peoples_PeopleType', count(*) FROM (
      SELECT unnest(string_split(personTypes, '|')) AS token FROM {contact}) WHERE token <> ''
    UNION ALL SELECT 'Cases', count(*) FROM {project}
    UNION ALL SELECT 'PracticeTypes', count(DISTINCT projectTypeId) FROM {phase_dim}
    UNION ALL SELECT 'Phases', count(*) FROM {phase_dim}
    UNION ALL SELECT 'CaseFigures', count(*) FROM {meds}
    UNION ALL SELECT 'IntakeDetails', count(*) FROM {intake}
    UNION ALL SELECT 'CaseDetails', count(*) FROM {casesummary}""")
def standard_model_run(t: Tables) -> DataFrame:
    raw = {n: t[n] for n in ("contact", "project", "meds", "intake", "casesummary")}
    raw["projecttype"] = project_types(t)
    paths = jobs.run_standard_model(raw, t.scratch("model"), standard_mapping(ORG))
    return row_counts(t, paths)
