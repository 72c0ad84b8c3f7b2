"""URL filter: stated rules first, then a path-template tree per host.

A rule is a host with a path prefix; it fits the host and its subdomains, and the longest fitting rule decides. Urls that a
rule decides are the labelled examples of the tree. Each host has a tree of path segments, grown level by level, in every
node that holds both labelled rows and rows to be judged, until there is none. A node's branches are its distinct segments:

- A segment of `min_rows` rows is stable. Stable ones without a labelled row stay literal. Those with labels fall by their
  share of blocked rows among the labelled into classes of a tenth, and neighbouring classes merge unless their shares differ
  by more than `z` standard errors: what is statistically alike is one branch (`/es#2`: `es` and one more).
- All others are variable. Those that hold a labelled row merge into one wildcard (`/#any`). Those that hold none join it only
  if the wildcard generalises, that is, if at least `min_values` different segments are labelled; else they stay apart
  (`/#unlabelled`), as nothing that is known of their siblings says anything about them.

Nodes where nothing is left to decide end (`/#rest`). A `#` can't occur in a path, so no segment is taken for a mark. A template is
rejected if its share of blocked rows among its labelled ones, smoothed by `weight` rows of the corpus-wide share, reaches
`threshold`; one without labels, which has nothing but the corpus-wide share, is allowed.

Everything is counted per distinct path, combined before each shuffle; only the branches of open nodes are joined back.

Edge cases: a null url, or one without `://`, has empty host and path, which no rule fits; a path of a url without one is
empty. Ties between rules of equal length go to the one that sorts first. Every row gives one row, repeated ones too. With
no labelled row the smoothed share is 0 and all other urls are allowed. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hammerprice.llm.columns import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: (verdict, host, path prefix)
Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ordered(rules: list[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda rule: (-len(rule[1] + rule[2]), rule[1] + rule[2]))


def fitting(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, null where none fits."""
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ordered(rules)]
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for fit, (verdict_of, h, p) in reversed(list(zip(fits, ordered(rules), strict=True))):
        rule = F.when(fit, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fit, F.lit(verdict_of)).otherwise(verdict)
    return rule, verdict


def branch_steps(paths: DataFrame, min_rows: int, min_values: int, z: float) -> DataFrame:
    """What is appended to the template of `paths` (`host`, `template`, `value` and counts), by branch of every open node."""
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    branches = written(paths.groupBy("host", "template", "value").agg(*sums), "url-branches")
    rare = F.col("n") < min_rows
    generalises = F.count(F.when(rare & (F.col("labelled") > 0), 1)) >= min_values
    nodes = branches.groupBy("host", "template").agg(*sums, generalises.alias("generalises"))
    nodes = nodes.where("labelled > 0 AND labelled < n").select("host", "template", "generalises")
    branches = branches.join(written(nodes, "url-nodes"), ["host", "template"])
    tenth = F.when(~rare & (F.col("labelled") > 0), F.expr("(10 * blocked) DIV labelled"))
    branches = written(branches.withColumn("tenth", tenth), "url-open-branches")
    # At most eleven rows of a node.
    classes = (
        branches.where("tenth IS NOT NULL")
        .groupBy("host", "template", "tenth")
        .agg(*sums, F.min("value").alias("least"), F.count(F.lit(1)).alias("values"))
    )
    in_order = Window.partitionBy("host", "template").orderBy("tenth")
    labelled, blocked = F.lag("labelled").over(in_order), F.lag("blocked").over(in_order)
    pooled = (F.col("blocked") + blocked) / (F.col("labelled") + labelled)
    gap = F.col("blocked") / F.col("labelled") - blocked / labelled
    differs = gap * gap > z * z * (pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / labelled))
    classes = classes.withColumn("cut", F.when(differs, 1).otherwise(0))
    classes = classes.withColumn("class", F.sum("cut").over(in_order))
    whole = Window.partitionBy("host", "template", "class")
    least, values = F.min("least").over(whole), F.sum("values").over(whole)
    name = F.when(values == 1, least).otherwise(F.concat(least, F.lit("#"), values.cast("string")))
    classes = written(classes.select("host", "template", "tenth", name.alias("name")), "url-classes")
    step = (
        F.when(F.col("name").isNotNull(), F.col("name"))
        .when(~rare, F.col("value"))
        .when((F.col("labelled") > 0) | F.col("generalises"), F.lit("#any"))
        .otherwise(F.lit("#unlabelled"))
    )
    named = branches.join(classes, ["host", "template", "tenth"], "left")
    return written(named.select("host", "template", "value", F.concat(F.lit("/"), step).alias("step")), "url-steps")


def templates(paths: DataFrame, min_rows: int, min_values: int, z: float) -> DataFrame:
    """Template of every distinct path: `host`, `path`, `template` and its counts `n`, `labelled`, `blocked`."""
    columns = ["host", "path", "template", "n", "labelled", "blocked"]
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    tree = paths.withColumn("segments", F.when(F.col("path") == "", F.array()).otherwise(segments))
    tree = tree.withColumn("template", F.lit(""))
    level, ended = 0, []
    while True:
        tree = tree.withColumn("value", F.get("segments", F.lit(level)))
        ended.append(tree.where("value IS NULL").select(*columns))
        tree = tree.where("value IS NOT NULL")
        stepped = tree.join(branch_steps(tree, min_rows, min_values, z), ["host", "template", "value"], "left")
        template = F.concat("template", F.coalesce("step", F.lit("/#rest")))
        stepped = stepped.withColumns({"template": template, "goes_on": F.col("step").isNotNull()}).drop("value", "step")
        stepped = written(stepped, "url-tree")
        ended.append(stepped.where("NOT goes_on").select(*columns))
        tree, level = stepped.where("goes_on").drop("goes_on"), level + 1
        if tree.isEmpty():
            return reduce(DataFrame.unionByName, ended)


def judge_urls(
    df: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    min_rows: int = 20,
    min_values: int = 20,
    z: float = 3.0,
    weight: float = 10.0,
    threshold: float = 0.8,
) -> DataFrame:
    """`page_id`, `host`, `path`, `rule`, `verdict`, and the `template` with its `purity`, of every row."""
    host, path = host_and_path(F.col(url_col))
    urls = df.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, ruled = fitting(rules, F.col("host"), F.col("path"))
    urls = urls.withColumns({"rule": rule, "ruled": ruled})
    blocked = F.when(F.col("ruled") == "block", 1).otherwise(0)
    paths = urls.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("ruled").alias("labelled"), F.sum(blocked).alias("blocked")
    )
    tree = written(templates(written(paths, "url-paths"), min_rows, min_values, z), "url-templates")
    total = tree.agg(
        F.coalesce(F.sum("blocked") / F.nullif(F.sum("labelled"), F.lit(0)), F.lit(0.0)).alias("corpus_share")
    )
    purity = (F.col("blocked") + weight * F.col("corpus_share")) / (F.col("labelled") + weight)
    by_template = (
        tree.groupBy("host", "template")
        .agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
        .join(F.broadcast(total))  # one row
        .select("host", "template", "labelled", purity.alias("purity"))
    )
    by_template = written(by_template, "url-purity")  # plain tables on both sides: a join with a hot key can be split
    judged = tree.select("host", "path", "template").join(by_template, ["host", "template"])
    rejected = (F.col("labelled") > 0) & (F.col("purity") >= threshold)
    verdict = F.coalesce("ruled", F.when(rejected, "block").otherwise("allow"))
    return urls.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )


def rules_sql(
    rules: list[Rule], min_rows: int, min_values: int, z: float, weight: float, threshold: float, levels: int = 8
) -> str:
    """The same judgement of table `pages` as one SQL statement, right where no node is open after `levels` levels."""
    longest = ordered(rules)
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for _, h, p in longest]
    rule = " ".join(f"WHEN {fit} THEN '{h}{p}'" for fit, (_, h, p) in zip(fits, longest, strict=True))
    ruled = " ".join(f"WHEN {fit} THEN '{verdict}'" for fit, (verdict, _, _) in zip(fits, longest, strict=True))
    steps = []
    for level in range(levels):
        steps.append(f"""
v{level} AS (SELECT *, CASE WHEN goes_on THEN segments[{level + 1}] END AS value FROM t{level}),
b{level} AS (SELECT host, template, value, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked FROM v{level}
  WHERE value IS NOT NULL GROUP BY ALL),
o{level} AS (SELECT host, template, count(*) FILTER (n < {min_rows} AND labelled > 0) >= {min_values} AS generalises
  FROM b{level} GROUP BY ALL HAVING sum(labelled) > 0 AND sum(labelled) < sum(n)),
k{level} AS (SELECT *, CASE WHEN n >= {min_rows} AND labelled > 0 THEN (10 * blocked) // labelled END AS tenth
  FROM b{level} JOIN o{level} USING (host, template)),
c{level} AS (SELECT host, template, tenth, sum(labelled) AS labelled, sum(blocked) AS blocked, min(value) AS least,
  count(*) AS vals FROM k{level} WHERE tenth IS NOT NULL GROUP BY ALL),
d{level} AS (SELECT *, lag(labelled) OVER w AS l2, lag(blocked) OVER w AS b2 FROM c{level}
  WINDOW w AS (PARTITION BY host, template ORDER BY tenth)),
e{level} AS (SELECT *, blocked::DOUBLE / labelled - b2::DOUBLE / l2 AS gap, (blocked + b2)::DOUBLE / (labelled + l2) AS pooled
  FROM d{level}),
g{level} AS (SELECT *, sum(CASE WHEN gap * gap > {z * z} * (pooled * (1 - pooled) * (1.0::DOUBLE / labelled + 1.0::DOUBLE / l2))
  THEN 1 ELSE 0 END) OVER (PARTITION BY host, template ORDER BY tenth) AS class FROM e{level}),
h{level} AS (SELECT host, template, tenth, CASE WHEN sum(vals) OVER w = 1 THEN min(least) OVER w
  ELSE min(least) OVER w || '#' || (sum(vals) OVER w)::BIGINT::VARCHAR END AS name FROM g{level}
  WINDOW w AS (PARTITION BY host, template, class)),
s{level} AS (SELECT k.host, k.template, k.value, '/' || CASE WHEN name IS NOT NULL THEN name WHEN n >= {min_rows} THEN value
  WHEN labelled > 0 OR generalises THEN '#any' ELSE '#unlabelled' END AS step
  FROM k{level} k LEFT JOIN h{level} h ON k.host = h.host AND k.template = h.template AND k.tenth = h.tenth),
t{level + 1} AS (SELECT v.host, path, n, labelled, blocked, segments, step IS NOT NULL AS goes_on,
  v.template || CASE WHEN v.value IS NULL THEN '' ELSE coalesce(step, '/#rest') END AS template
  FROM v{level} v LEFT JOIN s{level} s ON v.host = s.host AND v.template = s.template AND v.value = s.value)""")
    return f"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
a AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
u AS (SELECT *, CASE {rule} END AS rule, CASE {ruled} END AS ruled FROM a),
t0 AS (SELECT host, path, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked,
  CASE WHEN path = '' THEN [] ELSE string_split(regexp_replace(path, '^/', ''), '/') END AS segments, '' AS template,
  true AS goes_on
  FROM u GROUP BY host, path),{",".join(steps)},
p AS (SELECT host, template, sum(labelled) AS labelled, (sum(blocked)
  + {weight} * (SELECT coalesce(sum(blocked)::DOUBLE / nullif(sum(labelled), 0), 0) FROM t{levels}))
  / (sum(labelled) + {weight}) AS purity FROM t{levels} GROUP BY ALL)
SELECT page_id, u.host, u.path, rule,
  coalesce(ruled, CASE WHEN p.labelled > 0 AND purity >= {threshold} THEN 'block' ELSE 'allow' END) AS verdict
FROM u JOIN t{levels} f ON u.host = f.host AND u.path = f.path JOIN p ON f.host = p.host AND f.template = p.template"""
