"""URL filters: rules for hosts and paths, and a tree of path templates that learns from them, in DataFrame functions.

A rule names a host and a path; it fits the host and its subdomains where the url's path starts with the rule's, and
the longest rule that fits decides. Pages that a rule decides are the labelled ones. For all others a tree per host
decides, level by level of the path's segments, as deep as paths go:

* a position is variable if ``VALUES`` different segments or more have fewer than ``ROWS`` rows each; these become the
  wildcard ``*``. One that has labels joins them only if ``VALUES`` such segments have labels and its own are like those
  of the rest, so that no wildcard goes by the labels of one name; else it stays a branch of its own;
* all other segments are branches. Those with labels merge where they are alike: in the order of their blocked share, each
  with the one before it unless a likelihood-ratio test tells the two apart;
* a branch all or none of whose rows are labelled is not split further: nothing below it is left to decide.

A template is the host with the branches from root to leaf. It is rejected if the blocked share of its labelled rows,
smoothed by one row of each kind, reaches ``REJECT``; so a template needs labelled rows of its own to be rejected. Counts are
absolute: a section has the same template however large its host is.

Each level is one aggregation and one join on branch and segment; hot hosts are summed before the shuffle and
split by the join. Levels are written to the shared folder.

Defined results: a null url, or one without ``://``, has host and path empty and belongs to the host with the empty
name; repeated rows are judged alike and count as often as they are there; other columns are not read. In templates
``name+2`` is a branch merged of that and two more; ``*``, ``+`` and ``%`` in segments are written as in urls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadpulse.llm.common import landed, table

#: Verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Rows that make a segment a branch, and different segments with fewer that make a position variable.
ROWS = 5
VALUES = 5
REJECT = 0.8
#: Beyond this twice the logarithm of the likelihood ratio tells two shares apart: 95 % of the chi-squared distribution.
APART = 3.841
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host and path."""
    part = lambda k: F.coalesce(F.regexp_extract(url, PATTERN, k), F.lit(""))
    return pages.withColumns({"host": F.translate(part(1), CAPITALS, CAPITALS.lower()), "path": part(2)})


def with_rule(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``pages`` (host, path) with the longest rule that fits and its verdict, null where none does."""
    fits = lambda host, path: ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        rule = F.when(fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits(host, path), F.lit(kind)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "ruled": verdict})


def _apart(blocked: Column, labelled: Column, others_blocked: Column, others_labelled: Column) -> Column:
    """Twice the logarithm of the likelihood of two shares over that of a common one; 0 without labels on either side."""

    def weight(n: Column) -> Column:
        return F.when(n > 0, n * F.log(n)).otherwise(F.lit(0.0))

    def split(part: Column, of: Column) -> Column:
        return weight(part) + weight(of - part) - weight(of)

    both = split(blocked + others_blocked, labelled + others_labelled)
    return 2 * (split(blocked, labelled) + split(others_blocked, others_labelled) - both)


def branches(counts: DataFrame) -> DataFrame:
    """(template, segment, branch) of ``counts`` (template, segment, n, labelled, blocked)."""
    small = counts.where(F.col("n") < ROWS).groupBy("template")
    small = small.agg(
        F.count(F.lit(1)).alias("values"),
        F.count_if(F.col("labelled") > 0).alias("labelled_values"),
        F.sum("labelled").alias("all_labelled"),
        F.sum("blocked").alias("all_blocked"),
    )
    told = counts.join(small, "template", "left")
    rest = F.col("all_blocked") - F.col("blocked"), F.col("all_labelled") - F.col("labelled")
    alike = (F.col("labelled_values") >= VALUES) & (_apart(F.col("blocked"), F.col("labelled"), *rest) <= APART)
    folded = (F.col("n") < ROWS) & (F.col("values") >= VALUES) & ((F.col("labelled") == 0) | alike)
    told = told.withColumn("folded", F.coalesce(folded, F.lit(False)))
    name = F.replace(F.replace(F.replace("segment", F.lit("%"), F.lit("%25")), F.lit("*"), F.lit("%2A")), F.lit("+"), F.lit("%2B"))
    plain = told.where(F.col("folded") | (F.col("labelled") == 0))
    plain = plain.select("template", "segment", F.when(F.col("folded"), "*").otherwise(name).alias("branch"))
    kept = told.where(~F.col("folded") & (F.col("labelled") > 0)).withColumn("name", name)
    order = Window.partitionBy("template").orderBy(F.col("blocked") / F.col("labelled"), "segment")
    before = F.lag("blocked").over(order), F.lag("labelled").over(order)
    cut = F.coalesce(_apart(F.col("blocked"), F.col("labelled"), *before) > APART, F.lit(True))
    kept = kept.withColumn("cut", cut.cast("int")).withColumn("group", F.sum("cut").over(order))
    merged = kept.groupBy("template", "group").agg(F.min("name").alias("first"), (F.count(F.lit(1)) - 1).alias("more"))
    branch = F.when(F.col("more") == 0, F.col("first")).otherwise(F.concat("first", F.lit("+"), F.col("more").cast("string")))
    kept = kept.join(merged, ["template", "group"]).select("template", "segment", branch.alias("branch"))
    return plain.unionByName(kept)


def with_template(pages: DataFrame) -> DataFrame:
    """``pages`` (host, path, ruled) with template; the tree is that of these pages."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = pages.withColumns({"segments": segments, "template": F.col("host")})
    settled, level = [], 0
    while True:
        # Below a branch without labels, or of nothing but labelled rows, there is nothing to decide.
        sizes = rows.groupBy("template").agg(
            F.count(F.lit(1)).alias("n"), F.count("ruled").alias("labelled"), F.max(F.size("segments")).alias("deepest")
        )
        split = landed(sizes.where((F.col("labelled") > 0) & (F.col("labelled") < F.col("n")) & (F.col("deepest") > level)).select("template"), "split")
        if split.isEmpty():
            break
        settled.append(rows.join(split, "template", "left_anti"))
        rows = rows.join(split, "template", "left_semi").withColumn("segment", F.get("segments", F.lit(level)))
        counts = rows.where("segment is not null").groupBy("template", "segment")
        blocked = F.count_if(F.col("ruled") == "block")
        counts = counts.agg(F.count(F.lit(1)).alias("n"), F.count("ruled").alias("labelled"), blocked.alias("blocked"))
        found = rows.join(branches(landed(counts, "segments")), ["template", "segment"], "left")
        grown = F.concat("template", F.lit("/"), "branch")
        found = found.withColumn("template", F.when(F.col("segment").isNull(), F.col("template")).otherwise(grown))
        rows, level = landed(found.drop("segment", "branch"), "level"), level + 1
    for part in settled:
        rows = rows.unionByName(part)
    return rows.drop("segments")


def judged(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule, verdict, template and purity (the smoothed blocked share)."""
    rows = with_template(with_rule(with_parts(pages.select("page_id", "url")), rules))
    blocked = F.sum((F.col("ruled") == "block").cast("long"))
    purity = (F.coalesce(blocked, F.lit(0)) + 1) / (F.count("ruled") + 2)
    templates = rows.groupBy("template").agg(purity.alias("purity"))
    own = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    rows = rows.join(templates, "template")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template", "purity")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


#: Levels of the SQL twin, which can't go on until all is settled; paths of the given tables are shorter.
TWIN_LEVELS = 6


def _sql() -> str:
    fits = lambda host, path: f"(host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '{path}')"
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in longest) + " END"
    ruled = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in longest) + " END"
    steps = [
        f"""parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{PATTERN}', 1), ''), '{CAPITALS}',
        '{CAPITALS.lower()}') AS host, coalesce(regexp_extract(url, '{PATTERN}', 2), '') AS path FROM pages)""",
        f"""l0 AS (SELECT *, {rule} AS rule, {ruled} AS ruled, host AS template,
        list_filter(string_split(path, '/'), lambda s: s <> '') AS segments FROM parts)""",
    ]
    weight = lambda n: f"CASE WHEN ({n}) > 0 THEN ({n}) * ln({n}) ELSE 0 END"
    split = lambda x, n: f"({weight(x)} + {weight(f'({n}) - ({x})')} - {weight(n)})"
    apart = lambda b, n, c, m: f"2 * ({split(b, n)} + {split(c, m)} - {split(f'{b} + {c}', f'{n} + {m}')})"
    order = "PARTITION BY template ORDER BY blocked / labelled, segment"
    for k in range(TWIN_LEVELS):
        steps += [
            f"""s{k} AS (SELECT template FROM l{k} GROUP BY template
            HAVING count(ruled) > 0 AND count(ruled) < count(*) AND max(len(segments)) > {k})""",
            f"""n{k} AS (SELECT template, segments[{k + 1}] AS segment, count(*) AS n, count(ruled)::DOUBLE AS labelled,
            count(*) FILTER (ruled = 'block')::DOUBLE AS blocked,
            replace(replace(replace(segments[{k + 1}], '%', '%25'), '*', '%2A'), '+', '%2B') AS name
            FROM l{k} WHERE len(segments) > {k} AND template IN (FROM s{k}) GROUP BY ALL)""",
            f"""p{k} AS (SELECT template, count(*) AS many, count(*) FILTER (labelled > 0) AS labelled_many, sum(labelled) AS m,
            sum(blocked) AS c FROM n{k} WHERE n < {ROWS} GROUP BY template)""",
            f"""f{k} AS (SELECT n.*, coalesce(n < {ROWS} AND many >= {VALUES} AND (labelled = 0 OR (labelled_many >= {VALUES}
            AND {apart("blocked", "labelled", "(c - blocked)", "(m - labelled)")} <= {APART})), FALSE) AS folded
            FROM n{k} n LEFT JOIN p{k} p ON n.template = p.template)""",
            f"""q{k} AS (SELECT *, lag(blocked) OVER w AS c, lag(labelled) OVER w AS m FROM f{k} WHERE NOT folded AND labelled > 0
            WINDOW w AS ({order}))""",
            f"""g{k} AS (SELECT template, segment, name, sum(CASE WHEN m IS NULL OR {apart("blocked", "labelled", "c", "m")} > {APART}
            THEN 1 ELSE 0 END) OVER ({order} ROWS UNBOUNDED PRECEDING) AS part FROM q{k})""",
            f"""b{k} AS (SELECT template, segment, CASE WHEN folded THEN '*' ELSE name END AS branch FROM f{k}
            WHERE folded OR labelled = 0 UNION ALL
            SELECT template, segment, CASE WHEN count(*) OVER v = 1 THEN name
            ELSE min(name) OVER v || '+' || (count(*) OVER v - 1) END FROM g{k} WINDOW v AS (PARTITION BY template, part))""",
            f"""l{k + 1} AS (SELECT l.* EXCLUDE (template), CASE WHEN b.branch IS NOT NULL
            THEN l.template || '/' || b.branch ELSE l.template END AS template
            FROM l{k} l LEFT JOIN b{k} b ON l.template = b.template AND l.segments[{k + 1}] = b.segment)""",
        ]
    steps += [
        f"leaves AS (SELECT *, template AS leaf FROM l{TWIN_LEVELS})",
        """judged AS (SELECT *, (count(*) FILTER (ruled = 'block') OVER (PARTITION BY leaf) + 1)::DOUBLE
        / (count(ruled) OVER (PARTITION BY leaf) + 2) AS purity FROM leaves)""",
    ]
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""\nSELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END)
        AS verdict, leaf AS template, purity FROM judged"""
    )


QUERIES = {"op4_url_filters": op4_url_filters}
ORACLES = {"op4_url_filters": _sql()}
