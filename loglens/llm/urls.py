"""URL filter rules with redirect equivalence, by DataFrame operations only.

A rule (host, path, verdict) fits a url on its host or a subdomain whose path
begins with the rule's path; the longest fitting rule decides, and of equally
long ones an allowing one.  A url that no rule fits takes the decision of its
aliases: urls are aliases if edges connect them, over any number of steps.
Edges lead from a page to the target of its ``<link rel="canonical">`` and of its
``<meta http-equiv="refresh">``, from both ends of any other redirects that are
given as a table, and from every url to its canonical form (no scheme, fragment
or tracking parameters, no ``www.`` or ``m.`` before the host, no final ``/`` or
``.html``).  In a component an explicitly allowed url takes precedence: it is
blocked only if a rule blocks a url of it and no rule allows one.  What nothing
decides is allowed.

Nulls: a null url, or one without ``://``, has an empty host and path, no edges
and no rule, and is allowed.  A null or empty html has no links.  All tags of a page
count, with ``canonical`` anywhere in a list of relations; targets have their character
references resolved and are taken relative to the page's url (not to a ``<base>``);
those of other schemes (``mailto:``) are ignored.  Repeated rows each get a row.  An
empty table gives no rows.  A very long html is one row's work, a link one small row.
Columns other than those named in the calls have no influence, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm.components import connected_components
from loglens.llm.tables import Staged, table

# Fixed rules of the registered query: host, path, verdict.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _parts(url: Column) -> dict[str, Column]:
    """host, path and query of a url column; all empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    return {"host": F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
            "query": F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)}


def _key(host: Column, path: Column, query: Column) -> Column:
    """A url's name as a node: random order, fixed length; null without a host."""
    return F.when(host != "", F.md5(F.concat_ws("\x01", host, path, query)))


def _canonical_key(host: Column, path: Column, query: Column) -> Column:
    bare = F.regexp_replace(host, r"^(www\.|m\.)+", "")
    short = F.regexp_replace(F.regexp_replace(path, r"\.html$", ""), r"/+$", "")
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(r"^(utm_|ref=|fbclid=|gclid=)"))), "&")
    return F.when(host != "", F.md5(F.concat_ws("\x02", bare, short, kept)))


# The named entities of HTML that urls are written with.
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}
_ENTITY = r"(?s)&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&(?:amp|lt|gt|quot|apos);|[^&]+|&"


def _decoded(text: Column) -> Column:
    """The text with its character references resolved, once; those that name no character stay."""
    def one(x: Column) -> Column:
        digits = F.regexp_extract(x, r"^&#[xX]?([0-9a-fA-F]+);$", 1)
        code = F.conv(digits, 10, 16)
        code = F.when(x.rlike(r"^&#[xX]"), F.upper(digits)).otherwise(code)
        number = F.conv(code, 16, 10).cast("int")
        real = (digits != "") & (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        out = F.when(real, F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32"))
        for name, character in ENTITIES.items():
            out = out.when(x == name, F.lit(character))
        return out.otherwise(x)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)), one), "")


def _no_dots(path: Column) -> Column:
    """A path that begins with ``/``, without ``.`` and ``..`` segments."""
    segments = F.split(path, "/")
    none = F.expr("cast(array() as array<string>)")
    step = lambda acc, x: F.when(x == ".", acc).when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, x))
    kept = F.aggregate(F.slice(segments, 2, F.greatest(F.size(segments), F.lit(1))), none, step)
    end = F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), end)


def _absolute(target: Column, url: Column) -> Column:
    """A link target as an absolute url, resolved against the page's; null if it has another scheme or the page no url."""
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    base = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    path, tail = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(base, r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    joined = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    relative = (F.when(path != "", F.concat(origin, _no_dots(joined), tail)).when(tail.startswith("?"), F.concat(origin, base, tail))
                .otherwise(F.concat(origin, base, query, tail)))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target).when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None).cast("string"))
            .when(origin == "", F.lit(None).cast("string")).when(target.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit(":"), target)).otherwise(relative))


def _tags(html: Column, name: str) -> Column:
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(rf"(?is)<{name}\b[^>]*>"), F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, in either kind of quotes or none; empty without one."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*(F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)))


def html_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(from_url, to_url): all canonical links and refresh redirects of the pages."""
    html, url = F.col(html_col), F.col(url_col)
    canonical = F.transform(F.filter(_tags(html, "link"), lambda t: _attribute(t, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")), lambda t: _attribute(t, "href"))
    refresh = F.transform(F.filter(_tags(html, "meta"), lambda t: _attribute(t, "http-equiv").rlike(r"(?i)^\s*refresh\s*$")),
                          lambda t: F.regexp_extract(_attribute(t, "content"), r"""(?is)\burl\s*=\s*["']?([^"']*)""", 1))
    targets = F.transform(F.concat(canonical, refresh), lambda t: F.regexp_replace(_decoded(t), r"^\s+|\s+$", ""))
    found = pages.where(url.isNotNull()).select(url.alias("from_url"), F.explode(targets).alias("to_url")).where("to_url <> ''")
    return found.select("from_url", _absolute(F.col("to_url"), F.col("from_url")).alias("to_url")).where("to_url is not null")


def rule_for(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) for the distinct (host, path) of urls that a rule fits."""
    own = urls.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    near = own.withColumn("__suffix", F.explode(suffix))
    r = rules.select(F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("verdict").alias("__verdict"))
    fits = near.join(r, (F.col("__suffix") == F.col("__host")) & F.col("path").startswith(F.col("__path")))
    best = F.max(F.struct(F.length(F.concat("__host", "__path")).alias("n"), (F.col("__verdict") == "allow").alias("a"), F.concat("__host", "__path").alias("rule"), F.col("__verdict").alias("verdict")))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict) per row.  ``redirects`` has (from_url, to_url)."""
    links = html_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.union(redirects.select("from_url", "to_url").where("from_url is not null and to_url is not null"))
    links = Staged(links, "url-links").df
    p = _parts(F.col(url_col))
    # One row per page, without its html: what is read again below.
    seen = Staged(pages.select(F.col(id_col).alias("page_id"), *(c.alias(n) for n, c in p.items())), "url-parts").df
    ends = links.select(F.explode(F.array("from_url", "to_url")).alias("u")).select(*(c.alias(n) for n, c in _parts(F.col("u")).items()))
    names = Staged(seen.select("host", "path", "query").union(ends.select("host", "path", "query")).where("host <> ''").distinct()
                   .withColumns({"key": _key(F.col("host"), F.col("path"), F.col("query")), "canonical": _canonical_key(F.col("host"), F.col("path"), F.col("query"))}), "url-names").df
    a, b = _parts(F.col("from_url")), _parts(F.col("to_url"))
    edges = names.select(F.col("key").alias("a"), F.col("canonical").alias("b")).union(links.select(_key(**a).alias("a"), _key(**b).alias("b")))
    comp = connected_components(edges, "a", "b").df
    ruled = Staged(rule_for(names, rules), "url-rules").df
    decided = names.join(ruled, ["host", "path"]).join(comp.withColumnRenamed("node", "key"), "key")
    verdicts = decided.groupBy("root").agg(F.bool_or(F.col("verdict") == "allow").alias("allowed")).select("root", F.when(F.col("allowed"), "allow").otherwise("block").alias("spread"))
    spread = comp.join(verdicts, "root").select(F.col("node").alias("__key"), "spread")
    out = seen.withColumn("__key", _key(F.col("host"), F.col("path"), F.col("query"))).join(ruled, ["host", "path"], "left").join(spread, "__key", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", "spread", F.lit("allow")).alias("verdict"))


def q_op9(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages", "page_id", "url", "html"), rules)


ORACLE_OP9 = r"""
WITH RECURSIVE rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
s AS (SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
pg AS (SELECT row_number() OVER () AS rid, page_id, url, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM s),
lt AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS tag FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
mt AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')) AS tag FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
att AS (SELECT url, tag, 'rel' AS name FROM lt UNION ALL SELECT url, tag, 'http-equiv' FROM mt),
va AS (SELECT url, name, CASE name WHEN 'rel' THEN concat(regexp_extract(tag, '(?is)[\s"''/]rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1),
           regexp_extract(tag, '(?is)[\s"''/]rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2), regexp_extract(tag, '(?is)[\s"''/]rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3))
         ELSE concat(regexp_extract(tag, '(?is)[\s"''/]http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1),
           regexp_extract(tag, '(?is)[\s"''/]http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2), regexp_extract(tag, '(?is)[\s"''/]http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3)) END AS kind,
         CASE name WHEN 'rel' THEN concat(regexp_extract(tag, '(?is)[\s"''/]href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1),
           regexp_extract(tag, '(?is)[\s"''/]href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2), regexp_extract(tag, '(?is)[\s"''/]href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3))
         ELSE regexp_extract(concat(regexp_extract(tag, '(?is)[\s"''/]content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1),
           regexp_extract(tag, '(?is)[\s"''/]content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2), regexp_extract(tag, '(?is)[\s"''/]content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3)),
           '(?is)\burl\s*=\s*["'']?([^"'']*)', 1) END AS value FROM att),
de AS (SELECT url, list_transform(regexp_extract_all(value, '(?s)&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&(?:amp|lt|gt|quot|apos);|[^&]+|&'), lambda x: {'x': x, 'n':
           CASE WHEN regexp_matches(x, '^&#[0-9]+;$') THEN CAST(x[3:-2] AS BIGINT) WHEN regexp_matches(x, '^&#[xX][0-9a-fA-F]+;$') THEN CAST('0x' || x[4:-2] AS BIGINT) END}) AS parts
       FROM va WHERE regexp_matches(kind, CASE name WHEN 'rel' THEN '(?i)(^|\s)canonical(\s|$)' ELSE '(?i)^\s*refresh\s*$' END)),
raw AS (SELECT url, regexp_replace(array_to_string(list_transform(parts, lambda p: CASE
           WHEN p.n IS NOT NULL AND p.n > 0 AND p.n <= 1114111 AND NOT p.n BETWEEN 55296 AND 57343 THEN chr(CAST(p.n AS INTEGER))
           WHEN p.x = '&amp;' THEN '&' WHEN p.x = '&lt;' THEN '<' WHEN p.x = '&gt;' THEN '>' WHEN p.x = '&quot;' THEN '"' WHEN p.x = '&apos;' THEN '''' ELSE p.x END), ''), '^\s+|\s+$', '', 'g') AS t FROM de),
ba AS (SELECT url, t, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS origin, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS base, regexp_extract(url, '(?s)^[^?#]*(\?[^#]*)', 1) AS query,
         regexp_extract(t, '(?s)^([^?#]*)', 1) AS path, regexp_extract(t, '(?s)^[^?#]*(.*)$', 1) AS tail FROM raw WHERE t <> ''),
sg AS (SELECT *, string_split(CASE WHEN starts_with(path, '/') THEN path ELSE coalesce(nullif(regexp_extract(base, '(?s)^(.*/)', 1), ''), '/') || path END, '/') AS seg FROM ba),
st AS (SELECT *, list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(seg[2:], lambda x: [x])),
           lambda acc, x: CASE WHEN x[1] = '.' THEN acc WHEN x[1] = '..' THEN acc[1:len(acc) - 1] ELSE list_concat(acc, x) END) AS kept FROM sg),
lk AS (SELECT url AS f, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*://') THEN t WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN NULL WHEN origin = '' THEN NULL
         WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
         WHEN path <> '' THEN origin || '/' || array_to_string(kept, '/') || CASE WHEN seg[-1] IN ('.', '..') AND len(kept) > 0 THEN '/' ELSE '' END || tail
         WHEN starts_with(tail, '?') THEN origin || base || tail ELSE origin || base || query || tail END AS t FROM st),
en AS (SELECT u, CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM (SELECT unnest([f, t]) AS u FROM lk WHERE t IS NOT NULL)),
ep AS (SELECT DISTINCT u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM en),
nm AS (SELECT DISTINCT host, path, query, 'u' || host || chr(1) || path || chr(1) || query AS k,
         'c' || regexp_replace(host, '^(www\.|m\.)+', '') || chr(1) || regexp_replace(regexp_replace(path, '\.html$', ''), '/+$', '') || chr(1)
           || array_to_string(list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_|ref=|fbclid=|gclid=)'))), '&') AS c
       FROM (SELECT host, path, query FROM pg UNION SELECT host, path, query FROM ep) WHERE host <> ''),
e0 AS (SELECT k AS a, c AS b FROM nm
       UNION SELECT 'u' || x.host || chr(1) || x.path || chr(1) || x.query, 'u' || y.host || chr(1) || y.path || chr(1) || y.query
       FROM lk JOIN ep x ON x.u = lk.f JOIN ep y ON y.u = lk.t WHERE x.host <> '' AND y.host <> ''),
e AS (SELECT a, b FROM e0 UNION SELECT b, a FROM e0),
reach AS (SELECT a AS n, a AS r FROM e UNION SELECT reach.n, e.b FROM reach JOIN e ON reach.r = e.a),
comp AS (SELECT n, min(r) AS root FROM reach GROUP BY n),
fit AS (SELECT DISTINCT host, path, h || p AS rule, v, row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC, v) AS k
        FROM (SELECT DISTINCT host, path FROM nm) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
ru AS (SELECT host, path, rule, v FROM fit WHERE k = 1),
sp AS (SELECT root, CASE WHEN bool_or(v = 'allow') THEN 'allow' ELSE 'block' END AS v FROM nm JOIN ru USING (host, path) JOIN comp ON comp.n = nm.k GROUP BY root)
SELECT pg.page_id, pg.host, pg.path, ru.rule, coalesce(ru.v, sp.v, 'allow') AS verdict
FROM pg LEFT JOIN ru USING (host, path) LEFT JOIN comp ON comp.n = 'u' || pg.host || chr(1) || pg.path || chr(1) || pg.query LEFT JOIN sp USING (root)
"""
