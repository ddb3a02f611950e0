"""URL filters: rules for hosts and paths, and for what no rule decides, trust and distrust carried along links.

The graph has an edge from host to host where a page of the one links to the other. Trust starts at hosts whose urls the
rules allow, in proportion, and flows along the links; distrust starts at hosts whose urls the rules block, and flows
against them: who links to blocked hosts is suspect. Both are personalised PageRanks, computed in whole units of a
thousand millionth of a fully listed host, so that sums do not depend on their order. A host is blocked from half such a
unit of distrust on, unless it has as much trust.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcframe.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A link to another host in HTML: an absolute address, with or without its scheme.
LINK = r"""[Hh][Rr][Ee][Ff][\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?((?:[Hh][Tt][Tt][Pp][Ss]?:)?//[^\x20\x09-\x0D"'<>]+)"""
#: The trust or distrust of a host all of whose urls a rule decides, before any flows.
UNIT = 1_000_000_000
#: Of what a host has, so many hundredths flow on, each round.
DAMPING = 85
#: Rounds at most; what flows after them is less than a twenty-fifth.
ROUNDS = 20
#: A host is blocked from this distrust on.
THRESHOLD = UNIT // 2
#: Tasks that share the links or the pages of one host.
SALTS = 16


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains, where the path starts with this one."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://` or a url."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + F.lit(3), F.length(url))), F.lit(""))


def decide(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL if none does. Of equally long ones, block goes first, then text."""
    ordered = sorted(set(rules), key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    name = verdict = None
    for rule in ordered:
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        if name is None:
            name, verdict = F.when(fits, rule.text), F.when(fits, rule.verdict)
        else:
            name, verdict = name.when(fits, rule.text), verdict.when(fits, rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name.otherwise(none), verdict.otherwise(none))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`src` and `dst`, the hosts, and `path`, that of the address linked to: one row for each link to another host."""
    found = pages.select(host_of(F.col(url)).alias("src"), F.explode(F.regexp_extract_all(html, F.lit(LINK), F.lit(1))).alias("to"))
    to = F.when(F.startswith("to", F.lit("//")), F.concat(F.lit("x:"), "to")).otherwise(F.col("to"))
    found = found.select("src", host_of(to).alias("dst"), path_of(to).alias("path"))
    return found.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))


def _every() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING) -> DataFrame:
    """`host`, `trust` and `distrust` (long) of every host of `seeds` (the same columns: where both start).

    Each round, a host hands `damping` hundredths of its trust to those it links to (`edges`: distinct `src`, `dst`), in
    equal shares, and of its distrust to those that link to it; what it has is its start and what came in. Shares
    are cut to whole units. It ends before `rounds` when nothing changes. The links of one host are dealt over tasks.
    """
    out = edges.groupBy(F.col("src").alias("host")).agg(F.count("*").alias("degree"))
    into = edges.groupBy(F.col("dst").alias("host")).agg(F.count("*").alias("degree"))
    salt = lambda to: F.pmod(F.xxhash64(to), F.lit(SALTS)).cast("int").alias("salt")
    forward = edges.select(F.col("src").alias("host"), F.col("dst").alias("to"), F.lit(True).alias("trusts"), salt("dst"))
    backward = edges.select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(False).alias("trusts"), salt("src"))
    degrees = out.withColumn("trusts", F.lit(True)).union(into.withColumn("trusts", F.lit(False)))
    spread = degrees.select("*", _every())
    flows = cut(forward.union(backward).join(spread, ["host", "trusts", "salt"]))
    state, before = cut(seeds.select("host", "trust", "distrust")), None
    starts = state
    for _ in range(rounds):
        given = F.when(F.col("trusts"), F.col("trust")).otherwise(F.col("distrust"))
        # First the hundredths, so that nothing leaves the long.
        share = F.expr("given div 100 * damping div degree")
        handed = flows.join(state.select("*", _every()), ["host", "salt"]).select(
            "to", "trusts", "degree", given.alias("given"), F.lit(damping).cast("long").alias("damping")
        )
        came = handed.withColumn("share", share).groupBy(F.col("to").alias("host")).agg(
            F.sum(F.when(F.col("trusts"), F.col("share"))).alias("more_trust"),
            F.sum(F.when(~F.col("trusts"), F.col("share"))).alias("more_distrust"),
        )
        plus = lambda name: (F.col(name) + F.coalesce(f"more_{name}", F.lit(0))).alias(name)
        state = cut(starts.join(came, "host", "left").select("host", plus("trust"), plus("distrust")))
        # Both only grow, so equal sums are equal states.
        sums = state.agg(F.sum(F.col("trust").cast("decimal(38,0)")), F.sum(F.col("distrust").cast("decimal(38,0)"))).first()
        if sums == before:
            break
        before = sums
    return state


def judge_hosts(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", html: str = "html") -> DataFrame:
    """`host`, `trust`, `distrust` and `blocked` of every host that has a page or is linked to.

    A host starts with the share of its urls that the rules allow, or block: those of its pages, each as often as it
    occurs, and the links that other hosts have to it. NULL html has no links.
    """
    verdict = decide(F.col("host"), F.col("path"), rules)[1]
    kinds = ("allow", "block")
    counts = [*[F.count_if(verdict == kind).alias(kind) for kind in kinds], F.count("*").alias("urls")]
    linked = links(pages, url, html).withColumnRenamed("dst", "host").groupBy("src", "host").agg(*counts)
    linked = cut(linked)  # the html is read once
    known = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).filter(F.col("host") != "")
    known = known.groupBy("host").agg(*counts).union(linked.drop("src"))
    summed = known.groupBy("host").agg(*[F.sum(name).alias(name) for name in (*kinds, "urls")])
    share = lambda kind: F.expr(f"{kind} * {UNIT}L div urls")
    seeds = summed.select("host", share("allow").alias("trust"), share("block").alias("distrust"))
    state = propagate(seeds, linked.select("src", F.col("host").alias("dst")))
    return state.withColumn("blocked", (F.col("distrust") >= THRESHOLD) & (F.col("distrust") > F.col("trust")))


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """The id, `host`, `path`, `rule` (NULL if none fits) and `verdict` (allow or block) of every row.

    The longest rule that fits decides; otherwise the host's trust and distrust do, see `judge_hosts`. A NULL url, or one
    without `://`, has an empty host and path, which only rules that fit those decide; otherwise it is allowed. Rules
    are a list that the driver holds. Rows that repeat are judged each; ids do not matter. Other columns are not
    carried.
    """
    pages = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    blocked = judge_hosts(pages, rules).filter("blocked").select(F.col("host").alias("_host"), _every())
    host, path = F.col("host"), F.col("path")
    name, verdict = decide(host, path, rules)
    rows = pages.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.select("*", name.alias("rule"), verdict.alias("ruled"), F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)).cast("int").alias("dealt"))
    met = rows.join(blocked, (host == F.col("_host")) & (F.col("dealt") == F.col("salt")), "left")
    by_links = F.when(F.col("_host").isNotNull(), "block").otherwise("allow")
    return met.select(F.col("id").alias(id), "host", "path", "rule", F.coalesce("ruled", by_links).alias("verdict"))


def _sql(rules: Sequence[Rule] = RULES) -> str:
    ordered = sorted(rules, key=lambda r: -len(r.text))
    fits = lambda r: f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')"
    case = lambda of: "case " + " ".join(f"when {fits(r)} then '{of(r)}'" for r in ordered) + " end"
    rest = lambda of: f"case when contains({of}, '://') then substr({of}, instr({of}, '://') + 3) else '' end"
    cut_up = lambda of: (
        f"translate(regexp_extract({of}, '^[^/?#]*'), '{UPPER}', '{LOWER}') as host, regexp_extract({of}, '^[^/?#]*([^?#]*)', 1) as path"
    )
    link = LINK.replace("'", "''")
    parts = [f"""
with urls as (select page_id, html, coalesce({rest('url')}, '') as rest from pages),
parsed as (select page_id, html, {cut_up('rest')} from urls),
found as (select host as src, unnest(regexp_extract_all(html, '{link}', 1)) as target from parsed),
aimed as (select src, {rest("case when starts_with(target, '//') then 'x:' || target else target end")} as rest from found),
linked as (select * from (select src, {cut_up('rest')} from aimed) where src <> '' and host <> '' and src <> host),
edges as materialized (select distinct src, host as dst from linked),
flows as materialized (
  select src, dst, count(*) over (partition by src) as n_out, count(*) over (partition by dst) as n_in from edges),
known as (select host, path from parsed where host <> '' union all select host, path from linked),
judged as (select host, {case(lambda r: r.verdict)} as verdict from known),
s0 as materialized (
  select host, count(*) filter (verdict = 'allow') * {UNIT} // count(*) as trust,
    count(*) filter (verdict = 'block') * {UNIT} // count(*) as distrust
  from judged group by host)"""]
    for n in range(ROUNDS):
        parts.append(f"""
t{n} as (select dst as host, sum(trust // 100 * {DAMPING} // n_out) as more from flows join s{n} on src = host group by dst),
u{n} as (select src as host, sum(distrust // 100 * {DAMPING} // n_in) as more from flows join s{n} on dst = host group by src),
s{n + 1} as materialized (
  select s0.host, s0.trust + coalesce(t.more, 0) as trust, s0.distrust + coalesce(u.more, 0) as distrust
  from s0 left join t{n} t on s0.host = t.host left join u{n} u on s0.host = u.host)""")
    return ",".join(parts) + f"""
select page_id, p.host, path, {case(lambda r: r.text).replace('host', 'p.host')} as rule,
  coalesce({case(lambda r: r.verdict).replace('host', 'p.host')},
    case when distrust >= {THRESHOLD} and distrust > trust then 'block' else 'allow' end) as verdict
from parsed p left join s{ROUNDS} s on p.host = s.host
"""


SQL = _sql()
