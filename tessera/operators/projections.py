"""From upstream records to candidates: one projection a source, all in one shape.

A record is (source_id, upstream_id, url, payload), the payload a VARIANT. Each projection reads what it needs into
columns in a few steps, so that no expression is built into another over and over, and drops the records that its
source takes back. A record that lacks what identifies it is dropped too; `unusable` lists those.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import fields as N
from tessera.functions import keys as K
from tessera.functions import lenient as L
from tessera.functions.text import collapse, relative_path, title_words
from tessera.operators.catalog import held_back

# Where records keep things, and what they call transports.
OFFICIAL, PUBLISHER = "['io.modelcontextprotocol.registry/official']", "['io.modelcontextprotocol.registry/publisher-provided']"
REMOTE_TRANSPORTS = {"streamable-http": "streamable_http", "streamable_http": "streamable_http", "http": "streamable_http", "sse": "sse"}
PACKAGE_TRANSPORTS = {"streamable-http": "streamable_http", "streamable_http": "streamable_http", "sse": "sse", "stdio": "stdio"}
PLUGIN_SOURCES = ("relative", "url", "git-subdir", "github", "npm", "unknown")
SECRETS = "key|token|auth"
SKILL_FILE, DEFAULT_SKILL_CATEGORY = "/SKILL.md", "General"

REPO = "struct<host: string, owner: string, repo: string, subpath: string>"
PACKAGE = "struct<registry_type: string, identifier: string, version: string, runtime_hint: string, transport: string>"
REMOTE = "struct<transport: string, url: string, templated: boolean, header_names: array<string>>"
PLUGIN = "struct<marketplace: string, marketplace_repo: string, plugin: string, source_kind: string, source_value: string, sha: string>"
SIGNALS = ("github_stars", "github_forks", "npm_downloads_monthly", "npm_dependents", "smithery_use_count", "registry_version_count")
#: The fields that a component's candidates are fused by, with their types.
FIELDS = {
    "name": "string", "description": "string", "homepage": "string", "docs_url": "string", "license": "string", "mcp_url": "string", "transport": "string", "auth_hint": "string",
    "auth_note": "string", "setup_note": "string", "registry_name": "string", "smithery_qualified_name": "string", "npm_package": "string", "verified_upstream": "boolean", "tool_count": "int",
    "repo": REPO, "category": "string", "icon": "string", "connector_type": "string", "connector_config": "map<string,string>", "skill_name": "string", "source_ref": "string", "skill_path": "string",
    "commit_sha": "string", "model_invocable": "boolean", "allowed_tools": "array<string>", "skill_version": "string", "frontmatter_bytes": "int", "plugin": PLUGIN,
}
GATHERED = {"icon_url": "string", "tags": "array<string>", "packages": f"array<{PACKAGE}>", "remotes": f"array<{REMOTE}>", "deprecated": "boolean", "marketplace_reviewed": "boolean"}
CANDIDATE = {"kind": "string", "source_id": "string", "upstream_id": "string", "url": "string", "primary_key": "string", "keys": "array<string>", "trust_hint": "string", **dict.fromkeys(SIGNALS, "bigint"), **FIELDS, **GATHERED}


def candidates(df: DataFrame, kind: str, keys: list[Column], more_keys: Column | None = None, **columns: Column) -> DataFrame:
    """df in the shape of candidates: keys distinct and sorted, the strongest elected; columns not given are null."""
    every = F.array(*keys) if more_keys is None else F.concat(F.array(*keys), more_keys)
    held = df.withColumn("_keys", F.array_sort(F.array_distinct(F.filter(every, lambda k: k.isNotNull()))))
    given = {"kind": F.lit(kind), "source_id": F.col("source_id"), "upstream_id": F.substring("upstream_id", 1, 200), "url": F.substring("url", 1, N.URL), "keys": F.col("_keys"), "primary_key": K.elect(F.col("_keys")), "trust_hint": F.lit("indexed"), **columns}
    return held_back(held, F.size("_keys") > 0).select(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in CANDIDATE.items()])


def of_source(records: DataFrame, source_id: str) -> DataFrame:
    return records.where(F.col("source_id") == source_id)


def packages_of(server: Column) -> Column:
    """Packages that have a name, in order of registry and name, at most 8."""
    one = lambda p: F.struct(
        F.substring(F.lower(F.coalesce(F.nullif(L.spelled(p, "$.registryType", "$.registry_type", "$.registryName", "$.registry_name"), F.lit("")), F.lit("unknown"))), 1, 32).alias("registry_type"),
        F.substring(L.spelled(p, "$.identifier", "$.name"), 1, 200).alias("identifier"),
        F.substring(L.text(p, "$.version"), 1, 64).alias("version"),
        F.substring(L.spelled(p, "$.runtimeHint", "$.runtime_hint"), 1, 32).alias("runtime_hint"),
        F.when(L.text(p, "$.transport.type") == "", "stdio").otherwise(F.coalesce(N.looked_up(PACKAGE_TRANSPORTS, L.low(p, "$.transport.type")), F.lit("unknown"))).alias("transport"),
    )
    named = F.filter(F.transform(L.items(server, "$.packages"), one), lambda p: p["identifier"] != "")
    return F.slice(F.array_sort(named), 1, N.PACKAGES)


def remotes_of(server: Column) -> Column:
    """Remotes that have a URL, in the order that endpoints are elected in: by transport, then URL."""
    headers = lambda r: F.filter(F.transform(L.items(r, "$.headers"), lambda h: L.text(h, "$.name")), lambda n: n != "")
    # Of names that differ in case alone, the first.
    fresh = lambda names: F.filter(F.transform(names, lambda n, i: F.struct(n.alias("n"), (F.array_position(F.transform(names, F.lower), F.lower(n)) == i + 1).alias("first"))), lambda x: x["first"])
    url = lambda r: collapse(L.text(r, "$.url"), N.URL)
    transport = lambda r: F.coalesce(N.looked_up(REMOTE_TRANSPORTS, L.low(r, "$.type")), F.lit("unknown"))
    one = lambda r: F.struct(
        (F.array_position(F.array(*[F.lit(t) for t in N.TRANSPORTS]), transport(r))).alias("rank"), url(r).alias("at"),
        F.struct(transport(r).alias("transport"), url(r).alias("url"), url(r).contains("{").alias("templated"), F.slice(F.array_sort(F.transform(fresh(headers(r)), lambda x: x["n"])), 1, N.HEADERS).alias("header_names")).alias("remote"),
    )
    found = F.filter(F.transform(L.items(server, "$.remotes"), one), lambda r: r["at"] != "")
    return F.transform(F.array_sort(found), lambda r: r["remote"])


def registry(records: DataFrame) -> DataFrame:
    """The official registry: packages, remotes, and the one endpoint that can be trusted as it stands."""
    p = F.col("payload")
    df = of_source(records, "registry").withColumn("server", F.when(F.coalesce(L.kind_of(F.try_variant_get(p, "$.server", "variant")), F.lit("")).startswith("OBJECT"), F.try_variant_get(p, "$.server", "variant")).otherwise(p))
    s = F.col("server")
    meta = F.coalesce(F.try_variant_get(p, f"$._meta{OFFICIAL}", "variant"), F.try_variant_get(s, f"$._meta{OFFICIAL}", "variant"))
    df = df.withColumns({"full": L.text(s, "$.name"), "meta": meta})
    df = df.withColumns({"status": F.coalesce(F.nullif(L.low(F.col("meta"), "$.status"), F.lit("")), F.lit("active")), "old": L.exactly(F.col("meta"), "$.isLatest", False) | L.exactly(s, "$.isLatest", False)})
    df = held_back(df, (F.col("full") != "") & (F.col("status") != "deleted") & ~F.col("old"))
    inside = relative_path(L.text(s, "$.repository.subfolder"), 255)
    df = df.withColumns({"found": K.repo_of(L.text(s, "$.repository.url")), "inside": inside, "ordered": remotes_of(s), "packed": packages_of(s), "page": N.https(L.text(s, "$.websiteUrl"))})
    found = F.col("found")
    narrowed = F.when(found.isNotNull(), F.struct(found["host"].alias("host"), found["owner"].alias("owner"), found["repo"].alias("repo"), F.when(found["subpath"] == "", F.col("inside")).otherwise(found["subpath"]).alias("subpath")))
    df = df.withColumns({"place": narrowed, "elected": F.try_element_at(F.filter("ordered", lambda r: K.dialable(r["url"])), F.lit(1))})
    elected, first, headers = F.col("elected"), F.try_element_at("ordered", F.lit(1)), F.col("elected.header_names")
    endpoint = F.col("elected.url")
    bearer = F.exists(F.coalesce(headers, F.array().cast("array<string>")), lambda h: F.lower(h) == "authorization")
    hint = F.when(elected.isNull() | bearer, "bearer").when(F.size(headers) > 0, "header").otherwise("none")
    note = (
        F.when(elected.isNotNull() & ~bearer & (F.size(headers) > 0), F.concat(F.lit("Set the "), F.try_element_at(headers, F.lit(1)), F.lit(" header from the provider's dashboard.")))
        .when(elected.isNull() & F.coalesce(first["templated"], F.lit(False)), F.concat(F.lit("The published endpoint is templated ("), first["url"], F.lit("); enter the concrete URL from the provider's docs.")))
        .otherwise("")
    )
    active = (F.col("status") == "active") & (F.size("ordered") > 0)
    of_packages = F.transform(F.filter("packed", lambda x: x["registry_type"].isin("npm", "pypi")), lambda x: F.when(x["registry_type"] == "npm", K.mint("mcp", "npm", x["identifier"])).otherwise(K.mint("mcp", "pypi", x["identifier"])))
    return candidates(
        df, "mcp", [K.mint("mcp", "registry", F.col("full")), K.repo_key("mcp", F.col("place")), F.when(endpoint.isNotNull(), K.url_key("mcp", endpoint))], of_packages,
        trust_hint=F.when(active & endpoint.isNotNull(), "registry_verified").otherwise("indexed"),
        name=collapse(L.first_text(L.text(s, "$.title"), F.element_at(F.split("full", "/"), -1)), N.NAME), description=collapse(L.text(s, "$.description"), N.DESCRIPTION),
        homepage=F.col("page"), docs_url=N.first_url(F.col("page"), N.web_page(F.col("place")), L.text(s, "$.repository.url")), tags=N.tags(L.strings(s, f"$._meta{PUBLISHER}.tags")),
        deprecated=F.col("status") == "deprecated", mcp_url=endpoint, transport=F.coalesce("elected.transport", F.lit("unknown")), auth_hint=hint, auth_note=collapse(note, N.NOTE),
        setup_note=F.when(endpoint.isNull() & (F.size("packed") > 0), N.stdio_note(F.element_at("packed", 1)["identifier"])).otherwise(""),
        packages=F.col("packed"), remotes=F.slice("ordered", 1, N.REMOTES), registry_name=F.substring("full", 1, 132), verified_upstream=active, repo=F.col("place"),
    )


def smithery(records: DataFrame) -> DataFrame:
    """Smithery: how much a server is used, its endpoint from the detail or its first http connection."""
    p = F.col("payload")
    df = held_back(of_source(records, "smithery").withColumns({"qualified": L.text(p, "$.qualifiedName"), "gone": L.exactly(p, "$.unlisted", True) | L.exactly(p, "$.inactive", True)}), "qualified <> '' AND NOT gone")
    schema = lambda c: L.members(c, "$.configSchema.properties")
    df = df.withColumns({"detailed": F.coalesce(L.kind_of(F.try_variant_get(p, "$._detail", "variant")).rlike("^OBJECT<.+>"), F.lit(False)), "connections": L.items(p, "$._detail.connections")})
    df = df.withColumns({"over_http": F.filter("connections", lambda c: L.low(c, "$.type") == "http"), "settings": F.array_sort(F.array_distinct(F.flatten(F.transform("connections", lambda c: F.map_keys(schema(c))))))})
    from_http = F.try_element_at(F.filter(F.transform("over_http", lambda c: L.spelled(c, "$.deploymentUrl", "$.url")), lambda u: u != ""), F.lit(1))
    df = df.withColumn("deployment", L.first_text(L.text(p, "$._detail.deploymentUrl"), F.coalesce(from_http, F.lit(""))))
    # What a client may have to name: the settings, and for each the header it goes to in the first connection with it.
    headers = F.flatten(F.transform("connections", lambda c: F.transform(F.map_values(schema(c)), lambda v: L.text(v, "$['x-to'].header"))))
    df = df.withColumns({"plain": collapse(F.col("deployment"), N.URL + 1), "said": F.lower(F.concat_ws(" ", F.array_join("settings", " "), F.array_join(headers, " "))), "page": N.https(L.text(p, "$.homepage"))})
    df = df.withColumn("endpoint", F.when(K.dialable(F.col("plain")), F.col("plain")))
    silent = ~F.col("detailed") | (F.size("connections") == 0)
    hint = F.when(silent, "bearer").when(F.size("settings") == 0, "none").when(F.col("said").rlike(SECRETS), "bearer").otherwise("header")
    note = F.when(~silent & (F.size("settings") > 0), F.concat(F.lit("This server takes configuration ("), F.size("settings"), F.lit(" field(s)); supply values from the provider's docs."))).otherwise("")
    remote = F.struct(F.lit("streamable_http").alias("transport"), F.substring("deployment", 1, N.URL).alias("url"), F.col("deployment").contains("{").alias("templated"), F.array().cast("array<string>").alias("header_names"))
    package = F.struct(F.lit("smithery").alias("registry_type"), F.substring("qualified", 1, 200).alias("identifier"), F.lit("").alias("version"), F.lit("").alias("runtime_hint"), F.lit("stdio").alias("transport"))
    local = (F.size("connections") > 0) & (F.size("over_http") == 0) & F.col("endpoint").isNull()
    verified = L.exactly(p, "$.verified", True) | L.exactly(p, "$._detail.verified", True)
    tools = F.when(F.coalesce(L.kind_of(F.try_variant_get(p, "$._detail.tools", "variant")).startswith("ARRAY"), F.lit(False)), F.least(F.size(L.items(p, "$._detail.tools")), F.lit(N.TOOLS)))
    return candidates(
        df, "mcp", [K.mint("mcp", "smithery", F.col("qualified")), F.when(F.col("endpoint").isNotNull(), K.url_key("mcp", F.col("endpoint")))],
        trust_hint=F.when(verified, "smithery_verified").otherwise("indexed"), smithery_use_count=F.coalesce(L.count(p, "$.useCount"), L.count(p, "$._detail.useCount")),
        name=collapse(L.first_text(L.text(p, "$.displayName"), L.text(p, "$._detail.displayName"), F.col("qualified")), N.NAME),
        description=collapse(L.spelled(p, "$.description", "$._detail.description"), N.DESCRIPTION), homepage=F.col("page"), docs_url=N.first_url(F.col("page"), F.col("url")),
        deprecated=F.lit(False), mcp_url=F.col("endpoint"), transport=F.when(F.col("endpoint").isNotNull(), "streamable_http").otherwise("unknown"), auth_hint=hint, auth_note=collapse(note, N.NOTE),
        setup_note=F.when(local, N.stdio_note(F.substring("qualified", 1, 200))).otherwise(""), packages=F.when(local, F.array(package)).otherwise(F.array().cast(GATHERED["packages"])),
        remotes=F.when((F.size("over_http") > 0) & (F.col("deployment") != ""), F.array(remote)).otherwise(F.array().cast(GATHERED["remotes"])),
        smithery_qualified_name=F.substring("qualified", 1, 200), verified_upstream=verified, tool_count=tools,
    )


def npm(records: DataFrame) -> DataFrame:
    """npm search hits: downloads, dependents and a repository; never an endpoint."""
    p = F.col("payload")
    df = held_back(of_source(records, "npm").withColumns({"full": L.text(p, "$.package.name"), "insecure": L.yes(p, "$.flags.insecure")}), "full <> '' AND NOT insecure")
    df = df.withColumns({"place": K.repo_of(L.text(p, "$.package.links.repository")), "page": N.https(L.text(p, "$.package.links.homepage")), "id200": F.substring("full", 1, 200)})
    package = F.struct(F.lit("npm").alias("registry_type"), F.col("id200").alias("identifier"), F.substring(L.text(p, "$.package.version"), 1, 64).alias("version"), F.lit("").alias("runtime_hint"), F.lit("stdio").alias("transport"))
    return candidates(
        df, "mcp", [K.mint("mcp", "npm", F.col("full")), K.repo_key("mcp", F.col("place"))],
        npm_downloads_monthly=L.count(p, "$.downloads.monthly"), npm_dependents=L.count(p, "$.dependents"),
        name=collapse(F.col("full"), N.NAME), description=collapse(L.text(p, "$.package.description"), N.DESCRIPTION), homepage=F.col("page"),
        docs_url=N.first_url(F.col("page"), N.web_page(F.col("place")), F.col("url")), tags=N.tags(L.strings(p, "$.package.keywords")), license=F.substring(L.text(p, "$.package.license"), 1, 64),
        npm_package=F.substring("full", 1, 214), packages=F.array(package), setup_note=N.stdio_note(F.col("id200")), repo=F.col("place"),
    )


def github_topics(records: DataFrame) -> DataFrame:
    """Repositories found by topic: stars and forks; never an endpoint, never more than indexed."""
    p = F.col("payload")
    df = of_source(records, "github_topics").withColumns({"full": L.text(p, "$.full_name"), "web": L.text(p, "$.html_url"), "page": N.https(L.text(p, "$.homepage"))})
    df = held_back(df.withColumn("place", F.coalesce(K.repo_of(F.col("web")), K.repo_named(F.col("full")))), "place IS NOT NULL")
    return candidates(
        df, "mcp", [K.repo_key("mcp", F.col("place"))], github_stars=L.count(p, "$.stargazers_count"), github_forks=L.count(p, "$.forks_count"),
        name=collapse(L.first_text(L.text(p, "$.name"), F.col("place.repo")), N.NAME), description=collapse(L.text(p, "$.description"), N.DESCRIPTION), homepage=F.col("page"),
        docs_url=N.first_url(F.col("page"), F.col("web"), N.web_page(F.col("place"))), tags=N.tags(L.strings(p, "$.topics")), license=F.substring(L.text(p, "$.license.spdx_id"), 1, 64),
        deprecated=L.exactly(p, "$.archived", True), repo=F.col("place"),
    )


def skills(records: DataFrame) -> DataFrame:
    """Skills of marketplaces: identified by where their file lies; marketplace and plugin names, also old ones, are aliases."""
    p = F.col("payload")
    df = of_source(records, "marketplaces")
    first = lambda *names: F.coalesce(*[F.when(L.has(p, f"$.{n}"), F.try_variant_get(p, f"$.{n}", "variant")) for n in names])
    df = df.withColumns({"front": first("frontmatter", "skill_frontmatter", "skill"), "plug": first("plugin", "plugin_ref"), "origin": first("plugin_source", "source"), "repository": first("repo", "repository"), "path": relative_path(L.spelled(p, "$.skill_path", "$.skillPath", "$.path"), 255)})
    front, plug, origin, raw = (F.col(c) for c in ("front", "plug", "origin", "repository"))
    df = held_back(df, F.col("path").endswith(SKILL_FILE)).withColumn("dir", F.expr(f"substring(path, 1, length(path) - {len(SKILL_FILE)})"))
    said = lambda *names: L.first_text(*[L.text(p, f"$['{n}']") for n in names], *[L.text(front, f"$['{n}']") for n in names])
    inner = F.when(F.coalesce(L.kind_of(origin).startswith("OBJECT<"), F.lit(False)), origin).otherwise(plug)
    given = F.when(L.text(raw, "$.host").isin(*K.REPO_HOSTS) & L.text(raw, "$.owner").rlike(K.OWNER) & L.text(raw, "$.repo").rlike(K.REPO), F.struct(L.text(raw, "$.host").alias("host"), L.low(raw, "$.owner").alias("owner"), L.low(raw, "$.repo").alias("repo"), relative_path(L.text(raw, "$.subpath"), 255).alias("subpath")))
    df = df.withColumn("inner", inner)
    inner = F.col("inner")
    # Each text is read once; what is made of them comes in the next step.
    df = df.withColumns({
        "refs": F.array(L.text(raw, "$"), *[L.text(inner, f"$.{n}") for n in ("source_value", "url", "repo")]), "given": given, "own_market": L.spelled(p, "$.marketplace_repo", "$.marketplaceRepo"),
        "inner_market": L.text(inner, "$.marketplace_repo"), "plug_market": L.text(plug, "$.marketplace_repo"), "declared": said("name"), "told": said("description"), "licensed": said("license"), "versioned": said("skill_version", "version"),
        "sha": F.lower(L.spelled(p, "$.commit_sha", "$.sha", "$.commitSha")), "market": F.substring(L.first_text(L.spelled(p, "$.marketplace", "$.marketplace_name"), L.text(plug, "$.marketplace")), 1, 100),
        "plugin_name": F.substring(L.first_text(L.text(plug, "$.plugin"), L.text(p, "$.plugin_name")), 1, 100), "icon": L.text(p, "$.icon_url"), "sort": L.text(p, "$.category"),
        "origin_kind": L.spelled(inner, "$.source_kind", "$.kind"), "origin_value": F.substring(L.text(inner, "$.source_value"), 1, N.URL), "origin_sha": F.lower(L.first_text(L.text(inner, "$.sha"), L.spelled(p, "$.commit_sha", "$.sha"))),
    })
    parsed = F.filter(F.transform("refs", lambda r: F.coalesce(K.repo_of(r), K.repo_named(r))), lambda r: r.isNotNull())
    named = lambda text: F.when(text.rlike(N.SKILL_NAME), text)
    df = df.withColumns({
        "place": F.coalesce("given", F.try_element_at(parsed, F.lit(1)), K.repo_named(L.first_text(F.col("own_market"), F.col("inner_market")))), "market_repo": L.first_text(F.col("own_market"), F.col("plug_market")),
        "low": F.lower(F.trim("declared")), "base": F.lower(F.trim(F.element_at(F.split("dir", "/"), -1))),
    })
    df = held_back(df.withColumn("skill", F.coalesce(named(F.col("low")), named(F.col("base")))), "place IS NOT NULL AND skill IS NOT NULL")
    aliases = F.coalesce(*[F.when(L.has(p, f"$.{n}"), L.strings(p, f"$.{n}")) for n in ("aliases", "renamed_from", "previous_plugins")], F.array().cast("array<string>"))
    known = (F.col("market") != "") & (F.col("plugin_name") != "")
    plugin_keys = F.when(known, F.transform(F.concat(F.array("plugin_name"), aliases), lambda a: K.mint("skill", "plugin", F.concat_ws("/", "market", a, "skill")))).otherwise(F.array().cast("array<string>"))
    plugin = F.when(
        known & (F.col("market_repo") != "") & (F.length("market_repo") <= 165),
        F.struct(F.col("market").alias("marketplace"), F.col("market_repo").alias("marketplace_repo"), F.col("plugin_name").alias("plugin"), F.when(F.col("origin_kind").isin(*PLUGIN_SOURCES), F.col("origin_kind")).otherwise("unknown").alias("source_kind"), F.col("origin_value").alias("source_value"), F.when(F.col("origin_sha").rlike(N.SHA1), F.col("origin_sha")).otherwise("").alias("sha")),
    )
    stated = lambda *names: F.coalesce(*[F.when(L.has(x, f"$['{n}']"), L.yes(x, f"$['{n}']")) for x in (p, front) for n in names])
    tool_list = F.coalesce(*[F.when(L.has(x, f"$['{n}']"), F.when(L.text(x, f"$['{n}']") != "", F.split(L.text(x, f"$['{n}']"), ",")).otherwise(L.strings(x, f"$['{n}']"))) for x in (p, front) for n in ("allowed_tools", "allowed-tools")], F.array().cast("array<string>"))
    tools = F.slice(F.array_sort(F.array_distinct(F.filter(F.transform(tool_list, lambda t: F.substring(F.trim(t), 1, 64)), lambda t: t != ""))), 1, 32)
    tag_list = F.coalesce(F.when(L.has(p, "$.tags"), L.strings(p, "$.tags")), L.strings(p, "$.keywords"))
    icon = F.col("icon")
    size = F.coalesce(L.count(p, "$.frontmatter_bytes"), L.count(front, "$.frontmatter_bytes"), F.lit(0))
    title = title_words(F.col("sort"), 64)
    host = F.concat_ws("/", "place.host", "place.owner", "place.repo", "dir")
    return candidates(
        df, "skill", [K.mint("skill", "skill", host)], plugin_keys,
        name=collapse(L.first_text(F.col("declared"), F.col("skill")), N.NAME), description=collapse(F.col("told"), N.DESCRIPTION), docs_url=N.first_url(F.col("url")),
        license=F.substring("licensed", 1, 64), repo=F.col("place"), skill_name=F.col("skill"), category=F.coalesce(F.nullif(title, F.lit("")), F.lit(DEFAULT_SKILL_CATEGORY)),
        source_ref=F.substring(F.concat_ws("/", "place.owner", "place.repo", "dir"), 1, 300), skill_path=F.col("path"), commit_sha=F.when(F.col("sha").rlike(N.SHA1), F.col("sha")).otherwise(""),
        model_invocable=F.coalesce(stated("model_invocable"), ~stated("disable_model_invocation", "disable-model-invocation"), F.lit(True)), allowed_tools=tools,
        skill_version=F.substring("versioned", 1, 32), frontmatter_bytes=F.least(size, F.lit(8192)), tags=N.tags(tag_list),
        marketplace_reviewed=L.yes(p, "$.marketplace_reviewed"), icon_url=F.when(icon.rlike(N.AVATAR), icon).when(F.col("place.host") == "github.com", N.avatar(F.col("place.owner"))).otherwise(""), plugin=plugin,
    )


SOURCES = {"registry": registry, "smithery": smithery, "npm": npm, "github_topics": github_topics, "marketplaces": skills}


def project(records: DataFrame) -> DataFrame:
    """The candidates of all records; records of unknown sources make none."""
    return reduce(DataFrame.unionByName, [f(records) for f in SOURCES.values()])


def unusable(records: DataFrame) -> DataFrame:
    """(source_id, upstream_id, reason) of records that lack what identifies them."""
    p = F.col("payload")
    lacks = {
        "registry": L.first_text(L.text(p, "$.server.name"), L.text(p, "$.name")) == "", "smithery": L.text(p, "$.qualifiedName") == "", "npm": L.text(p, "$.package.name") == "",
        "github_topics": L.first_text(L.text(p, "$.full_name"), L.text(p, "$.html_url")) == "", "marketplaces": relative_path(L.spelled(p, "$.skill_path", "$.skillPath", "$.path"), 255) == "",
    }
    names = {"registry": "server name", "smithery": "qualified name", "npm": "package name", "github_topics": "full name", "marketplaces": "skill path"}
    reason = reduce(lambda out, s: out.when((F.col("source_id") == s) & lacks[s], f"no {names[s]}"), lacks, F.when(F.lit(False), ""))
    return records.withColumn("reason", reason).where("reason IS NOT NULL").select("source_id", "upstream_id", "reason")
