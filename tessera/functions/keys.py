"""Identity keys: kind:space:value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import collapse, relative_path

# A smaller rank is the stronger identity.
SPACE_RANK = {"repo": 0, "url": 1, "registry": 2, "npm": 3, "pypi": 4, "smithery": 5, "skill": 0, "plugin": 1}
OTHER_RANK, VALUE_CHARS = 99, 220
REPO_HOSTS = ("github.com", "gitlab.com", "bitbucket.org")
OWNER, REPO = "^[A-Za-z0-9_.-]{1,64}$", "^[A-Za-z0-9_.-]{1,100}$"
DIALABLE, URL_CHARS = r"^https://[^/@{#]+(?:/[^{#]*)?$", 512
DEEP_LINKS = ("tree", "blob", "src")


def mint(kind: str, space: str, value: Column) -> Column:
    """The key, or null where no value is left."""
    kept = F.substring(F.regexp_replace(F.lower(F.trim(value)), r"[^\x21-\x7e]+", "_"), 1, VALUE_CHARS)
    return F.when(kept != "", F.concat(F.lit(f"{kind}:{space}:"), kept))


def space_of(key: Column) -> Column:
    parts = F.split(key, ":", 3)
    return F.when(F.size(parts) == 3, parts[1]).otherwise("")


def space_rank(key: Column) -> Column:
    ranks = F.create_map(*[x for k, v in SPACE_RANK.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(ranks, space_of(key)), F.lit(OTHER_RANK))


def elect(keys: Column) -> Column:
    """The strongest of an array of keys: least space rank, then least key."""
    return F.array_min(F.transform(keys, lambda k: F.struct(space_rank(k).alias("rank"), k.alias("key"))))["key"]


def url_host(url: Column) -> Column:
    """Host in lower case, with a port unless it is a usual one; empty if there is none."""
    authority = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.lower(F.regexp_replace(authority, "^.*@", "")), ":(?:80|443)?$", "")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_key(kind: str, url: Column) -> Column:
    """A URL's key: host and path without final slashes; a URL without host is kept as it is."""
    host = url_host(url)
    return mint(kind, "url", F.when(host == "", F.trim(url)).otherwise(F.concat(host, F.regexp_replace(url_path(url), "/+$", ""))))


#: Host, owner, repository and the rest of a repository's URL.
REPO_URL = r"^(?:git\+)?https?://(?:[^/?#]*@)?(?i:www\.)?((?i:" + "|".join(h.replace(".", r"\.") for h in REPO_HOSTS) + r"))(?::[^/?#]*)?/+([A-Za-z0-9_.-]{1,64})/+([A-Za-z0-9_.-]{1,100}?)(?:\.git)?(?:/+([^?#]*))?(?:[?#].*)?$"


def repo_of(url: Column) -> Column:
    """struct<host, owner, repo, subpath> of a repository URL, else null. A deep link's branch isn't part of the path."""
    plain = collapse(url, 513)
    part = lambda i: F.regexp_extract(plain, REPO_URL, i)
    rest = F.regexp_replace(part(4), "^(?:" + "|".join(DEEP_LINKS) + ")/+[^/]+(?:/+|$)", "")
    return F.when(plain.rlike(REPO_URL), F.struct(F.lower(part(1)).alias("host"), F.lower(part(2)).alias("owner"), F.lower(part(3)).alias("repo"), relative_path(rest, 200).alias("subpath")))


def repo_named(name: Column) -> Column:
    """The same struct for owner/repo, which means GitHub; else null."""
    parts = F.filter(F.split(F.regexp_replace(F.trim(name), r"\.git$", ""), "/"), lambda s: s != "")
    owner, repo = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    return F.when(owner.rlike(OWNER) & repo.rlike(REPO), F.struct(F.lit("github.com").alias("host"), F.lower(owner).alias("owner"), F.lower(repo).alias("repo"), F.lit("").alias("subpath")))


def repo_key(kind: str, repo: Column) -> Column:
    place = F.concat_ws("/", repo["host"], repo["owner"], repo["repo"])
    return F.when(repo.isNotNull(), mint(kind, "repo", F.concat(place, F.when(repo["subpath"] != "", F.concat(F.lit("#"), repo["subpath"])).otherwise(""))))


def dialable(url: Column) -> Column:
    """An https endpoint that can be called as it stands: no template, fragment or user part, not too long."""
    return F.coalesce(url.rlike(DIALABLE) & (F.length(url) <= URL_CHARS), F.lit(False))
