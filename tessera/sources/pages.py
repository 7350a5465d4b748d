"""Recorded upstream pages, read into records: (source_id, upstream_id, url, payload).

A page row is (page, url, payload), page its number in the crawl and payload a VARIANT. Where a record occurs on several
pages, its first occurrence counts. A page without the list that its source sends is an error of the crawl; `faults`
lists those.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import fields as N
from tessera.functions import lenient as L
from tessera.functions.text import title_words
from tessera.operators.catalog import budget, first_rows, first_wins
from tessera.operators.projections import OFFICIAL

# Where sources keep their lists and pages, what front matter may measure, forms of GitHub's clone URLs.
LISTS = {"registry": "$.servers", "smithery": "$.servers", "npm": "$.objects", "github_topics": "$.items"}
SERVERS, PACKAGES = "https://registry.modelcontextprotocol.io/v0/servers", "https://www.npmjs.com/package/"
FRONT_BYTES, PATH_CHARS, SKILL = 8192, 255, "SKILL.md"
FULL_NAME = "^[A-Za-z0-9_.-]{1,64}/[A-Za-z0-9_.-]{1,100}$"
CLONE_URL = r"^(?:(?:git\+)?(?:https?|ssh|git)://(?:[^@/]+@)?github\.com/|(?:git@)?github\.com:)([A-Za-z0-9_.-]{1,64})/([A-Za-z0-9_.-]{1,100}?)(?:\.git)?/?$"
SHOWN, REPO_FILES, REF_CHARS, HEAD_REF, FULL_NAME_CHARS = 1000, 500, 300, "HEAD", 165
SKILL_KEYS = (
    "allowed_tools category commit_sha description docs_url frontmatter_bytes icon_url license marketplace marketplace_repo marketplace_reviewed model_invocable name plugin renamed_from repo skill_name "
    "skill_path skill_version source_ref tags"
).split()
CLIPPED = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
FRONT_MATTER = "name string, description string, version string, license string, allowed_tools array<string>, disable_model_invocation boolean, frontmatter_bytes int, fault string"


def _items(pages: DataFrame, path: str) -> DataFrame:
    return pages.select("page", "url", F.posexplode(L.items(F.col("payload"), path)).alias("pos", "item"))


def _named(found: DataFrame, source_id: str, upstream_id: Column, url: Column) -> DataFrame:
    named = found.withColumns({"upstream_id": upstream_id, "at": url}).where("upstream_id <> ''")
    return named.select("page", "pos", F.lit(source_id).alias("source_id"), "upstream_id", F.col("at").alias("url"), F.col("item").alias("payload"))


def _records(named: DataFrame, most: int | None) -> DataFrame:
    """The first occurrence of each record; of them, with `most`, the first so many in order of pages."""
    once = first_wins(named, ["upstream_id"], [F.col("page"), F.col("pos")])
    kept = once if most is None else first_rows(once, ["page"], [F.col("pos")], most)
    return kept.select("source_id", "upstream_id", "url", "payload")


def faults(pages: DataFrame, source_id: str) -> DataFrame:
    """(page, url) of pages that don't hold their source's list; the registry may send null for an empty one."""
    kind = F.coalesce(L.kind_of(F.try_variant_get("payload", LISTS[source_id], "variant")), F.lit("absent"))
    empty = (kind == "VOID") if source_id == "registry" else F.lit(False)
    return pages.where(~(kind.startswith("ARRAY") | empty)).select("page", "url")


def wire_faults(metadata: DataFrame) -> DataFrame:
    """(source_id, page, fault) of page metadata (source_id, page, items, first_id, pages_said): pages that repeat the first
    record of an earlier page, as npm does beyond its end, and empty pages below the last that the source says it has."""
    own = metadata.where("first_id IS NOT NULL")
    first = own.groupBy("source_id", "first_id").agg(F.min("page").alias("earliest"))
    again = own.join(first, ["source_id", "first_id"]).where("page > earliest").select("source_id", "page", F.lit("wrapped").alias("fault"))
    gap = metadata.where("items = 0 AND page < pages_said").select("source_id", "page", F.lit("empty below the last").alias("fault"))
    return again.union(gap)


def status_of(item: Column) -> Column:
    """A registry item's status, of the first holder that gives one."""
    return F.lower(L.first_text(L.text(item, f"$._meta{OFFICIAL}.status"), L.text(item, f"$.server._meta{OFFICIAL}.status"), L.text(item, "$.server.status")))


def registry_items(pages: DataFrame, include_deleted: bool = False, updated_since: str | None = None) -> DataFrame:
    """(page, pos, source_id, upstream_id, url, payload) of each server's latest versions, row by row, so for streams too.

    Deleted ones only if asked for, as tombstones of an incremental crawl. updated_since (RFC 3339) keeps what changed from
    then on, or doesn't say when it did; a window that hid deletions couldn't report one, so it asks for them.
    """
    i = F.col("item")
    # Either holder may say that a version is superseded.
    old = L.exactly(i, f"$._meta{OFFICIAL}.isLatest", False) | L.exactly(i, f"$.server._meta{OFFICIAL}.isLatest", False) | L.exactly(i, "$.server.isLatest", False) | L.exactly(i, "$.isLatest", False)
    found = _items(pages, "$.servers").where(~old)
    if updated_since is not None:
        at = F.try_to_timestamp(L.first_text(L.text(i, f"$._meta{OFFICIAL}.updatedAt"), L.text(i, f"$.server._meta{OFFICIAL}.updatedAt")))
        found = found.where(at.isNull() | (at >= F.to_timestamp(F.lit(updated_since))))
    if not include_deleted and updated_since is None:
        found = found.where(status_of(i) != "deleted")
    name = L.first_text(L.text(i, "$.server.name"), L.text(i, "$.name"))
    return _named(found, "registry", name, F.concat(F.lit(SERVERS + "/"), F.replace(F.url_encode(name), F.lit("+"), F.lit("%20")), F.lit("/versions")))


def registry_records(pages: DataFrame, include_deleted: bool = False, updated_since: str | None = None, most: int | None = None) -> DataFrame:
    """The latest version of each server, by registry_items."""
    return _records(registry_items(pages, include_deleted, updated_since), most)


def next_cursor(payload: Column) -> Column:
    """The registry's cursor, as it is; null at the end of the walk."""
    return F.when(L.text(payload, "$.metadata.nextCursor") != "", F.try_variant_get(payload, "$.metadata.nextCursor", "string"))


def pruned_detail(payload: Column) -> Column:
    """A server's detail as a struct of the eleven keys that are kept: no schema bodies, no tool inputs."""
    typed = lambda v, path, kinds, to: F.when(L.kind_of(F.try_variant_get(v, path, "variant")).rlike(kinds), F.try_variant_get(v, path, to))
    string = lambda v, path: typed(v, path, "^STRING", "string")
    header = lambda v: F.struct(F.when(string(v, "$['x-to'].header").isNotNull(), F.struct(string(v, "$['x-to'].header").alias("header"))).alias("x-to"))
    schema = lambda c: F.struct(F.map_from_entries(F.transform(F.array_sort(F.map_keys(L.members(c, "$.configSchema.properties"))), lambda k: F.struct(k, header(L.members(c, "$.configSchema.properties")[k])))).alias("properties"), F.array_sort(F.filter(F.transform(L.items(c, "$.configSchema.required"), lambda x: string(x, "$")), lambda x: x.isNotNull())).alias("required"))
    objects = lambda path: F.filter(L.items(payload, path), lambda x: L.kind_of(x).startswith("OBJECT"))
    connection = lambda c: F.struct(F.when(L.kind_of(F.try_variant_get(c, "$.configSchema", "variant")).startswith("OBJECT"), schema(c)).alias("configSchema"), string(c, "$.deploymentUrl").alias("deploymentUrl"), string(c, "$.type").alias("type"), string(c, "$.url").alias("url"))
    tools = F.when(L.has(payload, "$.tools"), F.transform(objects("$.tools"), lambda t: F.struct(string(t, "$.name").alias("name"))))
    return F.struct(
        F.transform(objects("$.connections"), connection).alias("connections"), *[string(payload, f"$.{c}").alias(c) for c in ("deploymentUrl", "description", "displayName", "iconUrl")], L.text(payload, "$.qualifiedName").alias("qualifiedName"),
        typed(payload, "$.remote", "^BOOLEAN", "boolean").alias("remote"), typed(payload, "$.security", "^OBJECT", "string").alias("security"), tools.alias("tools"), typed(payload, "$.useCount", "^BIGINT", "bigint").alias("useCount"), typed(payload, "$.verified", "^BOOLEAN", "boolean").alias("verified"),
    )


def smithery_records(pages: DataFrame, details: DataFrame, top: int = 500, web: str = "https://smithery.ai/server/", most: int | None = None) -> DataFrame:
    """Listed, active servers; the top ones by use, then name, with their detail (payload) below _detail, if there is one."""
    i = F.col("item")
    found = _items(pages, "$.servers").where(~(L.exactly(i, "$.unlisted", True) | L.exactly(i, "$.inactive", True)))
    name = L.text(i, "$.qualifiedName")
    rows = _records(_named(found, "smithery", name, F.concat(F.lit(web), name)), most)
    best = rows.orderBy(F.desc(F.coalesce(L.count(F.col("payload"), "$.useCount"), F.lit(0))), "upstream_id").limit(top).select(F.col("upstream_id").alias("_best"))
    known = first_wins(details.withColumn("_name", L.text(F.col("payload"), "$.qualifiedName")), ["_name"], [F.col("url")]).select("_name", F.to_json(pruned_detail(F.col("payload")), {"ignoreNullFields": "false"}).alias("_json"))
    wanted = known.join(best, F.col("_name") == F.col("_best"), "left_semi")
    joined = rows.join(wanted, F.col("upstream_id") == F.col("_name"), "left")
    # The detail goes below the summary's other keys, as text, since VARIANT values can't be put together otherwise.
    summary = F.to_json("payload")
    with_detail = F.parse_json(F.concat(F.regexp_replace(summary, r"\}$", ""), F.when(summary == "{}", "").otherwise(","), F.lit('"_detail":'), "_json", F.lit("}")))
    return joined.select("source_id", "upstream_id", "url", F.when(F.col("_json").isNull(), F.col("payload")).otherwise(with_detail).alias("payload"))


def npm_records(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Packages that npm doesn't call insecure, in whatever way it says so."""
    i = F.col("item")
    flag = F.try_variant_get(i, "$.flags.insecure", "variant")
    kind = F.coalesce(L.kind_of(flag), F.lit("VOID"))
    insecure = F.when(kind == "STRING", F.try_variant_get(i, "$.flags.insecure", "string") != "").when(kind == "BOOLEAN", F.try_variant_get(i, "$.flags.insecure", "boolean")).when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(i, "$.flags.insecure", "double") != 0).otherwise(kind.rlike("^(ARRAY|OBJECT)<.+>"))
    name = L.text(i, "$.package.name")
    return _records(_named(_items(pages, "$.objects").where(~insecure), "npm", name, F.concat(F.lit(PACKAGES), name)), most)


def topic_records(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Repositories by their full name in lower case."""
    i = F.col("item")
    name = L.text(i, "$.full_name")
    url = L.first_text(F.try_variant_get(i, "$.html_url", "string"), F.concat(F.lit("https://github.com/"), name))
    return _records(_named(_items(pages, "$.items").where(name.contains("/")), "github_topics", F.lower(name), url), most)


def discovered(pages: DataFrame, listed: DataFrame, only_listed: bool = True) -> DataFrame:
    """(repo, full_name, origin, place, visited): the repositories that a search's pages and people's lists name, once each.

    listed: (full_name, seed, place); Spark chooses the join by its size. Names in it that aren't
    owner/name count among seeds only. Origins come in the order seed, reviewed, topic; the first place of a name in its
    list, or its first occurrence on the pages, gives its spelling. With only_listed, what a search alone has found isn't
    visited: those rows are the report of what waits for a review. Visits are in order of origin, place and repo.
    Null names and pages without a list give nothing.
    """
    name = F.trim("full_name")
    own = listed.select(name.alias("full_name"), F.coalesce("seed", F.lit(False)).alias("seed"), F.col("place").cast("bigint").alias("place"))
    own = own.where(F.col("full_name").rlike(FULL_NAME) | (F.col("seed") & (F.col("full_name") != ""))).withColumn("repo", F.lower("full_name"))
    first = F.min(F.struct((~F.col("seed")).alias("later"), "place", "full_name")).alias("m")
    own = own.groupBy("repo").agg(first).select("repo", "m.full_name", F.when(F.col("m.later"), "reviewed").otherwise("seed").alias("origin"), "m.place")
    found = _items(pages, LISTS["github_topics"]).withColumn("full_name", clip(L.text(F.col("item"), "$.full_name"), FULL_NAME_CHARS)).where(F.col("full_name").rlike(FULL_NAME))
    found = found.groupBy(F.lower("full_name").alias("repo")).agg(F.min(F.struct("page", "pos", "full_name")).alias("m"))
    found = found.join(own.select("repo"), "repo", "left_anti").select("repo", "m.full_name", F.lit("topic").alias("origin"), F.lit(None).cast("bigint").alias("place"))
    return own.withColumn("visited", F.lit(True)).unionByName(found.withColumn("visited", F.lit(not only_listed)))


def window_bound(seen: DataFrame) -> DataFrame:
    """(topic, bound): the fewest stars that a topic's window has shown; its next window asks for at most so many."""
    return seen.groupBy("topic").agg(F.min(L.count(F.col("payload"), "$.stargazers_count")).alias("bound"))


def star_windows(stars: DataFrame, windows: int, shown: int = SHOWN) -> DataFrame:
    """(window, rows, bound) of (stars): a search shows the `shown` largest, and the next asks for at most the least of these.

    Windows overlap in the rows tied at their bounds, so the largest windows * shown values decide all of them, in one
    top-k; the descent ends where a window has no more than it shows, or doesn't get below its bound.
    """
    name = stars.columns[0]
    kind = stars.schema[name].dataType.simpleString()
    top = stars.select(F.col(name).alias("v")).where("v IS NOT NULL").orderBy(F.desc("v")).limit(windows * shown)

    def descend(batches):
        held = [b.column("v").to_numpy(zero_copy_only=False) for b in batches if b.num_rows]
        v = -np.concatenate(held) if held else np.zeros(0)  # ascending
        start, out = 0, []
        while start < len(v) and len(out) < windows:
            end = min(start + shown, len(v))
            if out and -v[end - 1] == out[-1][2]:
                break
            out.append((len(out) + 1, end - start, -v[end - 1]))
            if end - start < shown:
                break
            start = int(np.searchsorted(v, v[end - 1], side="left"))
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()), pa.array([float(o[2]) for o in out], pa.float64())], names=["window", "rows", "bound"])

    return top.coalesce(1).mapInArrow(descend, "window int, rows int, bound double").select("window", "rows", F.col("bound").cast(kind).alias("bound"))


def clip(text: Column, limit: int) -> Column:
    """One line of a source's text, cut; control characters become spaces."""
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(text, CLIPPED, " "), r"(?U)\s+", " ")), 1, limit)


def safe_path(path: Column) -> Column:
    """A path inside a repository, without empty and dot segments; null if it climbs out or is too long."""
    parts = F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda s: (s != "") & (s != "."))
    joined = F.array_join(parts, "/")
    return F.when(~F.exists(parts, lambda s: s == "..") & (F.length(joined) <= PATH_CHARS), joined)


def plugin_source(source: Column) -> Column:
    """struct<source_kind, source_value, path, ref, sha> of where a plugin lies: relative, url, git-subdir, github, npm or unknown."""
    kind_of, url = L.kind_of(source), clip(L.text(source, "$.url"), N.URL)
    kind, path = L.low(source, "$.source"), F.when(L.kind_of(F.try_variant_get(source, "$.path", "variant")) == "STRING", safe_path(L.text(source, "$.path"))).otherwise("")
    ref, sha = clip(L.text(source, "$.ref"), 200), F.lower(clip(L.text(source, "$.sha"), 64))
    sha = F.when(sha.rlike(N.SHA1), sha).otherwise("")
    shape = lambda kind, value, path=F.lit(""), ref=ref, sha=sha: F.struct(F.lit(kind).alias("source_kind"), value.alias("source_value"), path.alias("path"), ref.alias("ref"), sha.alias("sha"))
    package = clip(L.text(source, "$.package"), 214)
    none = F.lit("")
    return (
        F.when((kind_of == "STRING") & safe_path(L.text(source, "$")).isNotNull(), shape("relative", safe_path(L.text(source, "$")), none, none, none))
        .when(kind_of.startswith("OBJECT") & path.isNotNull() & (url != "") & ((kind == "git-subdir") | ((kind == "url") & (path != ""))), shape("git-subdir", url, path))
        .when(kind_of.startswith("OBJECT") & path.isNotNull() & (url != "") & (kind == "url"), shape("url", url))
        .when((kind == "github") & path.isNotNull() & L.text(source, "$.repo").rlike(FULL_NAME), shape("github", F.concat(F.lit("https://github.com/"), L.text(source, "$.repo")), path))
        .when((kind == "npm") & path.isNotNull() & (package != ""), shape("npm", package))
        .otherwise(shape("unknown", F.substring(F.coalesce(F.to_json(source), F.lit("null")), 1, N.URL), none, none, none))
    )


def target_repo(source: Column, marketplace_repo: Column) -> Column:
    """owner/repo that a plugin's files lie in; null where only GitHub's forms don't say."""
    found = F.regexp_extract(source["source_value"], CLONE_URL, 1), F.regexp_extract(source["source_value"], CLONE_URL, 2)
    return F.when(source["source_kind"] == "relative", marketplace_repo).when(source["source_kind"].isin("url", "git-subdir", "github") & (found[0] != ""), F.concat_ws("/", *found))


def plugins(manifests: DataFrame) -> DataFrame:
    """Plugins of manifests (marketplace_repo, url, payload), the first of each name; with their root and declared folders.

    A manifest without name, owner or list of plugins makes none.
    """
    m, i = F.col("payload"), F.col("item")
    owner = L.first_text(clip(L.text(m, "$.owner.name"), 100), clip(L.text(m, "$.owner"), 100))
    fine = manifests.where((clip(L.text(m, "$.name"), 100) != "") & L.has(m, "$.owner"))
    rows = fine.select("marketplace_repo", "url", clip(L.text(m, "$.name"), 100).alias("marketplace"), owner.alias("marketplace_owner"), F.coalesce(safe_path(L.text(m, "$.metadata.pluginRoot")), F.lit("")).alias("prefix"), F.posexplode(L.items(m, "$.plugins")).alias("pos", "item"))
    rows = first_wins(rows.withColumn("plugin", clip(L.text(i, "$.name"), 100)).where("plugin <> ''"), ["marketplace_repo", "plugin"], [F.col("pos")])
    said = F.when(L.text(i, "$.skills") != "", F.array(L.text(i, "$.skills"))).otherwise(L.strings(i, "$.skills"))
    dirs = F.filter(F.transform(said, lambda s: F.regexp_replace(safe_path(s), f"(^|/){SKILL}$", "")), lambda s: s.isNotNull())
    words = F.when(L.text(i, "$.keywords") != "", F.split(L.text(i, "$.keywords"), ",")).otherwise(L.strings(i, "$.keywords"))
    rows = rows.withColumn("source", plugin_source(F.try_variant_get(i, "$.source", "variant")))
    root = F.when(F.col("source.source_kind") == "relative", F.concat_ws("/", F.nullif("prefix", F.lit("")), F.nullif("source.source_value", F.lit("")))).otherwise(F.col("source.path"))
    return rows.select(
        "marketplace", "marketplace_repo", "marketplace_owner", "plugin", "url", "source", root.alias("plugin_root"), target_repo(F.col("source"), F.col("marketplace_repo")).alias("repo"), clip(L.text(i, "$.description"), N.DESCRIPTION).alias("description"),
        F.coalesce(F.nullif(title_words(L.text(i, "$.category"), 64), F.lit("")), F.lit("General")).alias("category"), clip(L.text(i, "$.license"), 64).alias("license"), N.tags(words).alias("tags"), F.array_sort(F.array_distinct(dirs)).alias("declared"),
    )


def renames(manifests: DataFrame) -> DataFrame:
    """(marketplace_repo, plugin, renamed_from): each name's old names, sorted."""
    pairs = manifests.select("marketplace_repo", F.explode(L.members(F.col("payload"), "$.renames")).alias("old", "new")).select("marketplace_repo", F.trim("old").alias("old"), L.text(F.col("new"), "$").alias("plugin")).where("old <> '' AND plugin <> ''")
    return pairs.groupBy("marketplace_repo", "plugin").agg(F.array_sort(F.collect_set("old")).alias("renamed_from"))


def skill_files(found: DataFrame, trees: DataFrame) -> DataFrame:
    """(marketplace_repo, plugin, skill_path) of plugins: files below a plugin's root in its repository's tree (repo,
    payload), at any depth but not at the top, and those in declared folders; too long ones go.

    A file meets plugins by its ancestors: each folder above it, the repository itself among them, is a root that some
    plugin may have. So a monorepo's plugins and files meet by equality, a row for each folder above a file.
    """
    tree = trees.select(F.lower("repo").alias("_repo"), F.explode(L.items(F.col("payload"), "$.tree")).alias("node"))
    n = F.col("node")
    files = tree.where(L.text(n, "$.type") == "blob").select("_repo", safe_path(L.text(n, "$.path")).alias("skill_path")).where(F.col("skill_path").endswith("/" + SKILL)).distinct()
    parts = F.split("skill_path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    rooted = files.select("_repo", "skill_path", F.explode(above).alias("_root"))
    mine = found.select("marketplace_repo", "plugin", F.lower("repo").alias("_own"), "plugin_root", "declared")
    listed = mine.join(rooted, (F.col("_own") == F.col("_repo")) & (F.col("plugin_root") == F.col("_root"))).select("marketplace_repo", "plugin", "_own", "skill_path")
    folder = lambda: F.concat_ws("/", F.nullif("plugin_root", F.lit("")), F.nullif("dir", F.lit("")))
    stated = mine.where("_own IS NOT NULL").select("marketplace_repo", "plugin", "_own", "plugin_root", F.explode("declared").alias("dir")).select("marketplace_repo", "plugin", "_own", F.concat_ws("/", F.nullif(folder(), F.lit("")), F.lit(SKILL)).alias("skill_path"))
    room = N.URL - F.length(docs_url(F.col("_own"), F.lit("")))
    return listed.union(stated).where((F.length("skill_path") <= room) & F.col("skill_path").contains("/")).select("marketplace_repo", "plugin", "skill_path").distinct()


def docs_url(repo: Column, path: Column) -> Column:
    """Where a skill's file can be read."""
    return F.concat(F.lit("https://github.com/"), repo, F.lit(f"/blob/{HEAD_REF}/"), path)


def skill_records(manifests: DataFrame, trees: DataFrame, texts: DataFrame, reviewed: DataFrame | None = None, most: int | None = None, per_repo: int = REPO_FILES) -> DataFrame:
    """Records of the skills that manifests (marketplace_repo, url, payload, page) lead to: plugins, their files in the trees
    (repo, payload), at most per_repo of a repository, and the files' texts (repo, skill_path, text), which go no further than
    their front matter. Files that aren't there or don't start with usable front matter make no record.

    reviewed: (marketplace_repo) that people have read. most: the first so many records, in order of repositories.
    """
    p = plugins(manifests)
    old = renames(manifests).select(F.col("marketplace_repo").alias("_m"), F.col("plugin").alias("_p"), "renamed_from")
    visits = skill_files(p, trees).join(p.withColumnsRenamed({"description": "plugin_description", "license": "plugin_license"}), ["marketplace_repo", "plugin"])
    visits = budget(visits.withColumn("_own", F.lower("repo")), ["_own"], [F.col("marketplace_repo"), F.col("plugin"), F.col("skill_path")], per_repo)
    read = texts.select(F.lower("repo").alias("_at"), F.col("skill_path").alias("_path"), front_matter(F.col("text")).alias("f")).where("f.fault IS NULL")
    shas = trees.select(F.lower("repo").alias("_tree"), L.low(F.col("payload"), "$.sha").alias("_sha")).groupBy("_tree").agg(F.min("_sha").alias("_sha"))
    rows = visits.join(read, (F.col("_own") == F.col("_at")) & (F.col("skill_path") == F.col("_path"))).join(shas, F.col("_own") == F.col("_tree"), "left").join(old, (F.col("marketplace_repo") == F.col("_m")) & (F.col("plugin") == F.col("_p")), "left")
    if reviewed is not None:
        rows = rows.join(F.broadcast(reviewed.select(F.lower("marketplace_repo").alias("_reviewed")).distinct()), F.lower("marketplace_repo") == F.col("_reviewed"), "left")
    rows = rows if most is None else first_rows(rows, ["_own"], [F.col("marketplace_repo"), F.col("plugin"), F.col("skill_path")], most)
    owner, name = F.split("_own", "/")[0], F.split("_own", "/")[1]
    folder = F.expr(f"substring(skill_path, 1, length(skill_path) - {len(SKILL) + 1})")
    sha = F.when(F.col("source.sha") != "", F.col("source.sha")).otherwise(F.when(F.col("_sha").rlike(N.SHA1), F.col("_sha")).otherwise(""))
    url = docs_url(F.col("repo"), F.col("skill_path"))
    told = {
        "skill_name": F.col("f.name"), "name": F.col("f.name"), "description": L.first_text(F.col("f.description"), F.col("plugin_description")), "category": F.col("category"), "source_ref": F.substring(F.concat_ws("/", "_own", folder), 1, REF_CHARS),
        "skill_path": F.col("skill_path"), "commit_sha": sha, "model_invocable": ~F.coalesce("f.disable_model_invocation", F.lit(False)), "allowed_tools": F.col("f.allowed_tools"), "skill_version": F.col("f.version"), "frontmatter_bytes": F.col("f.frontmatter_bytes"),
        "license": L.first_text(F.col("f.license"), F.col("plugin_license")), "tags": F.col("tags"), "docs_url": url, "icon_url": N.avatar(owner), "marketplace": F.col("marketplace"), "marketplace_repo": F.col("marketplace_repo"),
        "marketplace_reviewed": F.col("_reviewed").isNotNull() if reviewed is not None else F.lit(False), "repo": F.struct(F.lit("github.com").alias("host"), owner.alias("owner"), name.alias("repo"), folder.alias("subpath")),
        "plugin": F.struct("marketplace", "marketplace_repo", "plugin", "source.source_kind", "source.source_value", sha.alias("sha")), "renamed_from": F.coalesce("renamed_from", F.array().cast("array<string>")),
    }
    payload = F.to_json(F.struct(*[told[k].alias(k) for k in SKILL_KEYS]), {"ignoreNullFields": "false"})
    return rows.select(F.lit("marketplaces").alias("source_id"), F.concat_ws("#", "marketplace_repo", "plugin", folder).alias("upstream_id"), url.alias("url"), F.parse_json(payload).alias("payload"))


def more_than_pointers(records: DataFrame) -> DataFrame:
    """(upstream_id, key) of skill records that hold a key that none may have, or a text longer than a URL, at any of their
    two levels: nothing of a skill's instructions belongs in the catalog."""
    top = records.select("upstream_id", F.explode(L.members(F.col("payload"), "$")).alias("key", "v"))
    inner = top.select("upstream_id", "key", F.explode(F.concat(F.array("v"), L.items(F.col("v"), "$"), F.map_values(L.members(F.col("v"), "$")))).alias("x"))
    long = inner.where(F.length(F.try_variant_get("x", "$", "string")) > N.URL).where(L.kind_of(F.col("x")) == "STRING").select("upstream_id", "key")
    return top.where(~F.col("key").isin(*SKILL_KEYS)).select("upstream_id", "key").union(long).distinct()


def front_matter(text: Column) -> Column:
    """The scalars of a skill file's leading YAML block, or the fault that keeps it from being one."""
    def one(raw: str | None) -> dict:
        import re

        import yaml

        short = lambda v, n: re.sub(r"\s+", " ", re.sub(CLIPPED, " ", str(v))).strip()[:n] if isinstance(v, (str, int, float)) and not isinstance(v, bool) else ""
        body = (raw or "").lstrip("﻿").replace("\r\n", "\n").replace("\r", "\n")
        opened, _, rest = body.partition("\n")
        if opened != "---":
            return {"fault": "no block"}
        end = re.search(r"^---[^\S\n]*$", rest, re.M)
        block = (rest[: end.start()] if end else rest).removesuffix("\n")
        size = len(block.encode("utf-8", "surrogatepass"))
        if size > FRONT_BYTES:
            return {"fault": "too long"}
        if not end:
            return {"fault": "never closed"}
        try:
            found = yaml.safe_load(block)
        except yaml.YAMLError:
            return {"fault": "no YAML"}
        if not isinstance(found, dict):
            return {"fault": "no mapping"}
        name = short(found.get("name"), 64).lower()
        if not re.fullmatch(N.SKILL_NAME[1:-1], name):
            return {"fault": "no usable name"}
        tools = found.get("allowed-tools", found.get("allowed_tools"))
        tools = tools.split(",") if isinstance(tools, str) else [t for t in tools if isinstance(t, str)] if isinstance(tools, list) else []
        off = found.get("disable-model-invocation", found.get("disable_model_invocation"))
        off = off if isinstance(off, bool) else isinstance(off, str) and off.strip().lower() in ("true", "yes", "on", "1")
        kept = sorted({s for t in tools if (s := short(t, 64))})[:32]
        return {"name": name, "description": short(found.get("description"), N.DESCRIPTION), "version": short(found.get("version"), 32), "license": short(found.get("license"), 64), "allowed_tools": kept, "disable_model_invocation": off, "frontmatter_bytes": size}

    names = [c.split()[0] for c in FRONT_MATTER.split(", ")]

    @F.pandas_udf(FRONT_MATTER)
    def parse(texts: pd.Series) -> pd.DataFrame:
        rows = [one(t) for t in texts]
        return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype="object") for n in names})

    # Up to the closing line, or to where a block is too long in any case; a text without opening line goes no further than it.
    plain = F.replace(F.replace(F.ltrim(F.coalesce(text, F.lit("")), F.lit("\ufeff")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    head = F.substring(plain, 1, FRONT_BYTES + 64)
    return parse(F.when(F.startswith(head, F.lit("---\n")), F.coalesce(F.nullif(F.regexp_extract(head, r"(?s)^---\n(?:|.*?\n)---[^\S\n]*(?=\n|$)", 0), F.lit("")), head)).otherwise("no block"))
