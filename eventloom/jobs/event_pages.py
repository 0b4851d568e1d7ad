"""Captured pages derived from the relational tables: one event per order, as its own site and as directories show it.

The markup is one SQL expression over the order's facts that both engines run, so that a query's SQL reads the
same pages that the operators do. Most of what it holds comes from the tables; some parts go by the order's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.jobs import fixtures as fx

_SITE = "'https://www.' || lower(replace(host, '#', '-')) || '.example.com'"
_DAY = "'20' || substr(d, 3)"
_SLUG = "lower(replace(replace(name, '#', ''), ' ', '-')) || '-' || k"

#: By name: what a page is, over ``base`` with ``site, day, slug, partner`` (another supplier's name).
PARTS = {
    "ld": """'<script type="application/ld+json">{"@context":"https://schema.org","@graph":[{"@type":"Organization","name":"' || partner || '","description":"About ' || partner || '"},{"@type":["Event","Thing"],"name":"' || name || '","startDate":"' || day || 'T09:00","endDate":"' || day || '","description":"' || description || '","organizer":' || case when k % 4 = 0 then '"' || host || '"' when k % 4 = 1 then 'null' else '{"@type":"Person","name":"' || host || '"}' end || ',"location":' || case when k % 3 = 0 then '[{"@type":"Place","name":"Hall of ' || city || '","address":"' || k || ' Main Street"}]' else '{"@type":"Place","name":"Hall of ' || city || '","address":{"streetAddress":"' || k || ' High Road","addressLocality":"' || city || '","addressRegion":"' || country || '","postalCode":"' || k || '","addressCountry":"' || country || '"}}' end || '}]}</script><script type="application/ld+json">{broken</script>'""",
    "head": """case when k % 5 < 3 then ld else '<meta property="og:title" content="' || name || '"><meta property="og:site_name" content="' || host || '">' end || case when k % 2 = 0 then '<meta name="description" content="' || description || ' by ' || speaker || '">' else '' end""",
    "nav": """'<nav><a href="/register">Register now</a><a href="/sponsors-' || k || '">Our sponsors</a><a href="/exhibitor-list/' || k || '">Exhibitors</a><a href="https://other.example.org/partners">Partners</a><a href="#program">Program</a></nav>'""",
    "body": """'<main><h1>' || name || '</h1><p>Opens ' || day || ' in ' || city || '</p><section class="sponsors-list"><h2>Sponsors</h2><div class="sponsor-card"><h3>' || partner || '</h3><p>Partner of ' || host || '</p><a href="https://partner' || k || '.example.org/">Site</a></div><div class="sponsor-card"><img alt="' || host || ' Ltd" src="a.png"></div></section><section id="people"><h2>Keynote speakers</h2><div class="card"><h3>' || speaker || '</h3><p>Chair</p><p>' || host || '</p></div></section>' || case when k % 7 = 0 then '<p>Program coming soon</p>' else '' end || '</main><footer>contact</footer>'""",
    "main": """'<html><head>' || head || '</head><body>' || nav || body || '</body></html>'""",
    "sponsors": """'<html><body><h1>Sponsors</h1><section class="sponsor-grid"><div class="sponsor-card"><h3>' || partner || '</h3></div><div class="sponsor-card"><h3>Third ' || speaker || '</h3></div></section><a class="next" href="/sponsors-' || k || '?page=2">more</a></body></html>'""",
    "listing": """'<html><head><meta name="keywords" content="' || description || '"></head><body><h1>' || name || ' on ' || day || '</h1><ul><li>Location: <strong>' || city || ', ' || country || '</strong></li>' || case when k % 3 = 0 then '' else '<li>Date: ' || day || '</li>' end || case when k % 4 = 0 then '' else '<li>Organization: ' || host || '</li>' end || case when k % 5 = 0 then '<li>Venue: Hall ' || (k % 100) || ', ' || city || ', State, ' || country || '</li>' else '' end || '<li><a href="/conferences/' || lower(country) || '">' || country || ' events</a></li></ul><a href="/event/' || k || '/program">Program</a><div id="event-description">About <b>' || name || '</b></div><div id="event-organization">' || host || ' of ' || city || '</div></body></html>'""",
    "ticket": """'<html><head>' || ld || '</head><body><h1> ' || name || ' </h1><a class="eps-org-container" href="/org/' || k || '"><h2 class="eps-org-name">' || host || '</h2></a><div data-ehref="https://go.example.com/go.php?id=' || k || '">Tickets</div><a href="/' || lower(replace(city, ' ', '-')) || '/business">' || city || ' business events</a></body></html>'""",
    "rows": """'<html><body><input id="desktopdropdown" value=" /ajax/' || k || ' "><table id="listing-events"><tbody><tr class="event-card x"><td><div class="eventTime b" data-start-date="' || day || '" data-end-date="' || day || '">' || day || '</div></td><td data-id="' || k || '" onclick="window.open(''' || site || '/event/' || k || '?a=1'')"><h2 data-edition="' || k || '">' || name || '</h2></td><td>' || city || '</td><td>' || description || '</td>' || case when k % 2 = 0 then '<td>' || country || '</td><td>' || partner || '</td>' else '' end || '</tr><tr class="other"><td>x</td><td>y</td></tr></tbody></table><div id="featured-events"><div class="premium-event event-card"><span data-id="' || k || '" onclick="window.open(''' || site || '/event/f' || k || ''')">go</span><h3>' || speaker || ' gala</h3><div class="eventTime" data-start-date="' || day || '">' || day || '</div></div></div><script type="application/ld+json">[{"@type":"ItemList","itemListElement":[{"position":1,"item":"' || site || '/event/' || k || '","name":"Listed ' || name || '"},{"position":2,"item":{"@type":"Event","url":"' || site || '/event/j' || k || '","name":"' || speaker || '","startDate":"' || day || '","location":{"@type":"Place","name":"' || city || '"}}},{"item":"' || site || '/about"}]},{"@type":"Course Event","name":"' || host || '","location":[{"url":"' || site || '/conference/' || k || '"}]}]</script><a href="' || site || '/events/a' || k || '" title="' || partner || '">See</a></body></html>'""",
    "pager": """'<html><head><link rel="next" href="/list/' || k || '?page=9"></head><body><a href="/list/' || k || '?page=2#x">2</a><a href="/list/' || k || '?page=3">3</a><a href="/list/' || k || '?page=2">again</a><a href="https://other.example.org/?page=4">4</a><a href="/list/' || k || '/pdf?page=5">5</a><a href="/more/' || k || '">older</a><a href="/list/' || k || '?page=6" rel="nofollow next">six</a></body></html>'""",
}


def _layers(*names: str) -> list[str]:
    """The parts that the named ones are made of, and then these, each after what it needs."""
    needs = {"head": ["ld"], "main": ["ld", "head", "nav", "body"], "ticket": ["ld"]}
    out: list[str] = []
    for n in names:
        out += [x for x in (*needs.get(n, []), n) if x not in out]
    return out


#: Orders that a task makes pages of at most, and at least while there are fewer tasks than four to a core.
MOST_ORDERS, LEAST_ORDERS = 10_000, 250


def n_tasks(orders: int, cores: int) -> int:
    """Into how many tasks the making and reading of pages is dealt: by rows, for rows are a tenth of the pages that they become."""
    return max(1, -(-orders // MOST_ORDERS), min(4 * cores, -(-orders // LEAST_ORDERS)))


def dealt(rows: DataFrame, key: str, orders: DataFrame) -> DataFrame:
    """Thin rows dealt by their key into a number of tasks that goes by the number of orders.

    The joins before give as few partitions as their bytes ask for, down to one; pages made of them would all be read in these.
    """
    return rows.repartition(n_tasks(orders.count(), rows.sparkSession.sparkContext.defaultParallelism), key)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base`` with ``site, day, slug`` and ``partner``, the supplier of the order's last line."""
    last = fx.read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("f")).select(F.col("l_orderkey").alias("k"), F.col("f.l_suppkey").alias("s_suppkey"))
    partner = last.join(fx.read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("partner")), "s_suppkey").drop("s_suppkey")
    thin = dealt(fx.base(spark, sf_dir).join(partner, "k"), "k", fx.read(spark, sf_dir, "orders"))
    return thin.withColumns({"site": F.expr(_SITE), "day": F.expr(_DAY), "slug": F.expr(_SLUG)})


def pages(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """``events`` with the named pages as columns."""
    out = events(spark, sf_dir)
    for n in _layers(*names):
        out = out.withColumn(n, F.expr(PARTS[n]))
    return out


EVENTS = (
    f"{fx.BASE}, ev as (select base.*, {_SITE} as site, {_DAY} as day, {_SLUG} as slug, s_name as partner from base "
    "join (select l_orderkey, arg_max(l_suppkey, (l_linenumber, l_partkey, l_suppkey)) as s from lineitem group by 1) on l_orderkey = k join supplier on s_suppkey = s)"
)


def sql(*names: str) -> str:
    """``with`` clauses up to ``pg``: ``ev`` with the named pages as columns."""
    out, at = f"with {EVENTS}", "ev"
    for n in _layers(*names):
        out += f", pg_{n} as (select *, {PARTS[n]} as {n} from {at})"
        at = f"pg_{n}"
    return f"{out}, pg as (select * from {at}) "
