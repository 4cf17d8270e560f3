"""URL filters: block and allow rules, spread over addresses that redirects and canonical links make equivalent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.components import components
from tallyworks.llm.store import save

#: Query parameters that name where a visitor came from, not what is shown.
TRACKING = r"(^|&)(utm_[^=&]*|ref)=[^&]*"


def host_of(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?`` or ``#``, with A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """The resource a URL names, whatever its scheme, fragment, final slash or tracking parameters; null without host."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&", "")
    plain = F.concat(host_of(url), F.regexp_replace(path_of(url), "/$", ""))
    return F.when(host_of(url) != "", F.concat(plain, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def resolved(link: Column, base: Column) -> Column:
    """A link as an absolute http(s) address, as read on the page ``base``: absolute, without scheme, from the root,
    or relative, with ``.`` and ``..`` taken up; empty for other schemes and where the page has no host."""
    page = F.when(F.rlike(base, F.lit(r"(?i)^https?://[^/?#]")), base)
    scheme, host = F.regexp_extract(page, r"^([^:]*:)", 1), F.regexp_extract(page, r"^([^:]*://[^/?#]*)", 1)
    path, query = path_of(page), F.regexp_extract(page, r"(?s)^[^?#]*(\?[^#]*)", 1)
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), r"[^/]*$", "")
    rest = F.regexp_extract(link, r"(?s)([?#].*)$", 1)
    own = F.regexp_extract(link, r"(?s)^([^?#]*)", 1)
    joined = F.split(F.when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(folder, own)), "/", -1)
    # a step .. takes away the last segment, never the empty one before the first slash
    steps = F.aggregate(
        joined,
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done)
        .when(step == "..", F.slice(done, 1, F.greatest(F.lit(1), F.size(done) - 1)))
        .otherwise(F.concat(done, F.array(step))),
    )
    # a final . or .. names a folder
    walked = F.concat(F.array_join(steps, "/"), F.when(F.rlike(own, F.lit(r"(^|/)\.\.?$")), "/").otherwise(""))
    walked = F.when(own == "", F.concat(path, F.when(F.startswith(rest, F.lit("?")), "").otherwise(query))).otherwise(walked)
    return F.coalesce(
        F.when(link == "", "")
        .when(F.rlike(link, F.lit(r"(?i)^https?://")), link)
        .when(F.rlike(link, F.lit(r"(?i)^[a-z][a-z0-9+.-]*:")), "")
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .otherwise(F.concat(host, walked, rest)),
        F.lit(""),
    )


def links_in(html: Column, base: Column) -> Column:
    """Addresses that a page at ``base`` names as its canonical link or sends its reader on to; empty without one."""
    tags = F.concat(
        F.regexp_extract_all(html, F.lit(r"(?i)(<link\b[^>]*\brel\s*=\s*[\"']?\s*canonical\b[^>]*>)"), 1),
        F.regexp_extract_all(html, F.lit(r"(?i)(<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b[^>]*>)"), 1),
    )
    # in quotes up to the same quote, which may hold blanks; else up to a blank
    found = F.transform(
        tags,
        lambda t: F.regexp_extract(
            t,
            r"(?i)\b(?:href|url)\s*=\s*(?:\"\s*([^\">]*)|'\s*([^'>]*)|([^\"'\s>]+))", 0,
        ),
    )
    bare = lambda t: F.regexp_replace(t, r"(?i)^(?:href|url)\s*=\s*[\"']?\s*|\s+$", "")
    return F.transform(found, lambda t: resolved(decoded(bare(t)), base))


def decoded(text: Column) -> Column:
    """Character references that addresses are written with: ``&amp;``, by number too, quotes and slashes."""
    for reference, character in (
        (r"quot|#0*34|#x0*22", '"'), (r"apos|#0*39|#x0*27", "'"), (r"#0*47|#x0*2f|sol", "/"), (r"amp|#0*38|#x0*26", "&"),
    ):
        text = F.regexp_replace(text, f"(?i)&(?:{reference});", character)
    return text


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``action`` of the longest rule that fits to every distinct ``url``.

    ``rules`` has ``host``, ``path`` and ``action`` (allow or block). A rule fits its
    host and all subdomains, if the path starts with the rule's. A url meets only
    the rules of its own host and parents of it: a join by equal hosts.
    Of rules equally long, allow goes first. ``rule`` is null where none fits.
    """
    distinct = urls.select("url").distinct().withColumn("host", host_of(F.col("url")))
    distinct = distinct.withColumn("path", path_of(F.col("url")))
    labels = F.split("host", r"\.", -1)
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    given = rules.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("action").alias("_action")
    ).where("_action in ('allow', 'block')")
    met = distinct.withColumn("_parent", F.explode(parents)).join(given, F.col("_parent") == F.col("_host"))
    best = (
        met.where(F.startswith("path", F.col("_path")) & (F.col("host") != ""))
        .groupBy(F.col("url").alias("_url"))
        .agg(
            F.max(
                F.struct(
                    F.length(F.concat("_host", "_path")).alias("n"),
                    (F.col("_action") == "allow").alias("allowed"),
                    F.concat("_host", "_path").alias("rule"),
                    F.col("_action").alias("action"),
                )
            ).alias("_best")
        )
    )
    return distinct.join(best, F.col("url") == F.col("_url"), "left").select(
        "url", "host", "path", F.col("_best.rule").alias("rule"), F.col("_best.action").alias("action")
    )


def filter_pages(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``alias_of`` to every row of ``pages`` (``url``, ``html``).

    A url with a rule has that rule's verdict. The others take the verdict of
    their aliases: addresses joined by redirects (an optional table ``source``,
    ``target``), canonical links or refreshes in the pages, resolved against the page's url, and spellings of one
    address that differ in scheme, fragment, final slash or tracking parameters.
    Aliases are connected components of that graph. If a rule allows any alias
    the verdict is allow, else block if a rule blocks any, else allow. ``alias_of``
    is the least address of the component.
    A null url or one without host has an empty host and path, no rule or alias, and is allowed.
    Repeated rows stay repeated. Native column functions and joins throughout.
    """
    named = save(
        pages.select("url", address(F.col("url")).alias("node"), links_in(F.col("html"), F.col("url")).alias("links")).distinct(),
        "links",
    )
    judged = save(judge(named.where("url is not null"), rules), "judged")
    edges = named.select(F.col("node").alias("a"), F.explode("links").alias("to"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(address(F.col("source")).alias("a"), F.col("target").alias("to")))
    edges = edges.select("a", address(F.col("to")).alias("b")).where("a is not null and b is not null")
    roots = components(edges, "a", "b")
    nodes = judged.withColumn("_node", address(F.col("url")))
    nodes = nodes.join(roots, nodes["_node"] == roots["node"], "left").withColumn(
        "alias_of", F.coalesce("root", "_node")
    )
    spread = nodes.where("alias_of is not null").groupBy(F.col("alias_of").alias("_root")).agg(
        F.max((F.coalesce("action", F.lit("")) == "allow")).alias("_allowed"),
        F.max((F.coalesce("action", F.lit("")) == "block")).alias("_blocked"),
    )
    blocked = F.coalesce(F.col("_blocked") & ~F.col("_allowed"), F.lit(False))
    decided = nodes.join(spread, F.col("alias_of") == F.col("_root"), "left").select(
        F.col("url").alias("_url"), "host", "path", "rule",
        F.coalesce("action", F.when(blocked, "block").otherwise("allow")).alias("verdict"), "alias_of",
    )
    plain = pages.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "alias_of")])
    return plain.join(decided, plain["url"] == decided["_url"], "left").select(
        *[plain[c] for c in plain.columns],
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        "alias_of",
    )
