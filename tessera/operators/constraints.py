"""What a published entry may hold, as one table of fields; types, checks, the strict reader and the JSON Schema come from it."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegralType, MapType, StringType, StructType, _parse_datatype_string

from tessera.functions import fields as N
from tessera.functions import keys as K
from tessera.functions import lenient as L
from tessera.functions import scoring as S
from tessera.functions.text import clean, collapse

KINDS = ("mcp", "skill")
# Patterns, bounds and enumerations that a published line is held to.
MCP_URL = r"^https://[^\s@/{}#]+(/[^\s{}#]*)?$"
SOURCE_REF = r"^([A-Za-z0-9_.-]+)/([A-Za-z0-9_.-]+)(?:/(.+))?$"
OWNER_REPO = r"^[A-Za-z0-9_.-]{1,64}/[A-Za-z0-9_.-]{1,100}$"
SIGNALS = ("github_stars", "github_forks", "npm_downloads_monthly", "npm_dependents", "smithery_use_count", "registry_version_count")
PACKAGE_TRANSPORTS = ("stdio", *N.TRANSPORTS)
PLUGIN_SOURCES = ("relative", "url", "git-subdir", "github", "npm", "unknown")
CONFIG_PAIRS, CONFIG_KEY, CONFIG_VALUE, TOOL_NAMES, TOOL_NAME = 10, 64, 500, 32, 64
DIALECT = "https://json-schema.org/draft/2020-12/schema"


@dataclass(frozen=True)
class Field:
    """One field. least and most bound a number's value, a string's length or a collection's size; null says whether it may
    be null, and without `default` it has to be stated. check adds what a pattern can't say."""

    name: str
    kind: str
    least: float | None = None
    most: float | None = None
    pattern: str = ""
    values: tuple = ()
    each: str = ""  # of an array's strings
    null: bool = False
    default: object = ...
    check: object = None


REPO = [
    Field("host", "string", values=K.REPO_HOSTS), Field("owner", "string", pattern=K.OWNER), Field("repo", "string", pattern=K.REPO),
    Field("subpath", "string", default="", check=lambda c: (c == "") | normal_path(c, 255)),
]
SOURCE = [Field("source_id", "string", values=N.SOURCE_IDS), Field("upstream_id", "string", 1, 200), Field("url", "string", 1, N.URL, pattern="^https://.*$")]
COUNTS = [Field(s, "bigint", 0, null=True, default=None) for s in SIGNALS]
PACKAGE = [
    Field("registry_type", "string", 1, 32), Field("identifier", "string", 1, 200), Field("version", "string", most=64, default=""), Field("runtime_hint", "string", most=32, default=""),
    Field("transport", "string", values=PACKAGE_TRANSPORTS, default="stdio"),
]
REMOTE = [Field("transport", "string", values=N.TRANSPORTS), Field("url", "string", 1, N.URL), Field("templated", "boolean", default=False), Field("header_names", "array<string>", most=N.HEADERS, default=[])]
PLUGIN = [
    Field("marketplace", "string", 1, 100), Field("marketplace_repo", "string", pattern=OWNER_REPO), Field("plugin", "string", 1, 100), Field("source_kind", "string", values=PLUGIN_SOURCES),
    Field("source_value", "string", most=N.URL), Field("sha", "string", default="", check=lambda c: (c == "") | c.rlike(N.SHA1)),
]
#: Structs by name: what they hold.
STRUCTS = {"RepoRef": REPO, "SourceRef": SOURCE, "PopularitySignals": COUNTS, "PackageRef": PACKAGE, "RemoteRef": REMOTE, "PluginRef": PLUGIN}


def normal_path(path: Column, most: int) -> Column:
    """A relative path with forward slashes and no empty or dot segments."""
    return (F.length(path) <= most) & ~path.contains("\\") & ~F.exists(F.split(path, "/"), lambda s: s.isin("", ".", ".."))


def _web(form: str):
    return lambda c: (c == "") | (c.rlike(form) & (F.length(c) <= N.URL))


_EITHER = [
    Field("schema_version", "int", values=(1,), default=1), Field("canonical_key", "string", pattern=N.KEY_FORM), Field("alias_keys", "array<string>", most=N.ALIASES, each=N.KEY_FORM, default=[]),
    Field("slug", "string", pattern=N.SLUG_FORM), Field("name", "string", 1, N.NAME), Field("description", "string", most=N.DESCRIPTION), Field("homepage", "string", default="", check=_web("^https://")),
    Field("docs_url", "string", default="", check=_web("^https?://")), Field("icon_url", "string", most=N.URL, default="", check=_web(f"{N.SERVER_ICON}|{N.AVATAR}")), Field("marketplace_reviewed", "boolean", default=False),
    Field("trust_tier", "string", values=S.TIERS), Field("popularity", "double", 0.0, 1.0, default=0.0), Field("popularity_signals", "PopularitySignals", default=dict.fromkeys(SIGNALS)),
    Field("sources", "array<SourceRef>", 1, N.SOURCES), Field("tags", "array<string>", default=[]), Field("license", "string", most=64, default=""), Field("deprecated", "boolean", default=False), Field("curated_fields", "array<string>", default=[]),
]
ENTRIES = {
    "mcp": [
        *_EITHER, Field("kind", "string", values=("mcp",)), Field("repo", "RepoRef", null=True, default=None), Field("category", "string", values=tuple(N.CATEGORY_ICONS)), Field("icon", "string", values=tuple(sorted(N.ICONS))),
        Field("connector_type", "string", values=tuple(sorted(N.CONNECTORS)), null=True, default=None), Field("mcp_url", "string", most=N.URL, pattern=MCP_URL, null=True, default=None, check=K.dialable), Field("url_unverified", "boolean", default=False),
        Field("transport", "string", values=N.TRANSPORTS, default="unknown"), Field("auth_hint", "string", values=N.AUTH_HINTS, default="bearer"), Field("auth_note", "string", most=N.NOTE, default=""), Field("setup_note", "string", most=N.NOTE, default=""),
        Field("stdio_only", "boolean", default=False),
        Field("connector_config", "map<string,string>", most=CONFIG_PAIRS, default={}, check=lambda c: F.forall(F.map_entries(c), lambda e: F.length(e["key"]).between(1, CONFIG_KEY) & F.coalesce(F.length(e["value"]) <= CONFIG_VALUE, F.lit(False)))),
        Field("packages", "array<PackageRef>", most=N.PACKAGES, default=[]), Field("remotes", "array<RemoteRef>", most=N.REMOTES, default=[]), Field("tool_count", "int", 0, N.TOOLS, null=True, default=None),
        Field("registry_name", "string", most=132, default=""), Field("smithery_qualified_name", "string", most=200, default=""), Field("npm_package", "string", most=214, default=""), Field("verified_upstream", "boolean", default=False),
    ],
    "skill": [
        *_EITHER, Field("kind", "string", values=("skill",)), Field("repo", "RepoRef"), Field("skill_name", "string", pattern=N.SKILL_NAME), Field("category", "string", 1, 64, default="General"),
        Field("source_ref", "string", most=300, pattern=SOURCE_REF), Field("skill_path", "string", check=lambda c: c.endswith("/SKILL.md") & normal_path(c, 255)), Field("plugin", "PluginRef", null=True, default=None),
        Field("commit_sha", "string", default="", check=lambda c: (c == "") | c.rlike(N.SHA1)), Field("model_invocable", "boolean", default=True), Field("allowed_tools", "array<string>", default=[]),
        Field("skill_version", "string", most=32, default=""), Field("frontmatter_bytes", "int", 0, 8192, default=0),
    ],
}


def spark_type(kind: str) -> str:
    """A field's type in Spark's words."""
    for name, fields in STRUCTS.items():
        if name in kind:
            return kind.replace(name, "struct<" + ", ".join(f"{f.name}: {spark_type(f.kind)}" for f in fields) + ">")
    return kind


def entry_type(kind: str) -> StructType:
    """The type of a line of that kind: all its fields, by name."""
    return _parse_datatype_string("struct<" + ", ".join(f"`{f.name}`: {spark_type(f.kind)}" for f in sorted(ENTRIES[kind], key=lambda f: f.name)) + ">")


def entry_field(f: Field):
    """A field's type as a Spark object."""
    return _parse_datatype_string(f"struct<x: {spark_type(f.kind)}>")["x"].dataType


def holds(f: Field, c: Column) -> Column:
    """Whether a value is what its field may hold."""
    inner = next((n for n in STRUCTS if n in f.kind), None)
    parts = []
    if f.least is not None or f.most is not None:
        size = F.length(c) if f.kind == "string" else F.size(c) if f.kind.startswith(("array", "map")) else c
        parts += [size >= F.lit(f.least)] if f.least is not None else []
        parts += [size <= F.lit(f.most)] if f.most is not None else []
    if f.pattern:
        parts.append(c.rlike(f.pattern) & ~c.contains("\n"))
    if f.values:
        parts.append(c.isin(*f.values))
    if f.each:
        parts.append(F.forall(c, lambda x: F.coalesce(x.rlike(f.each), F.lit(False))))
    if f.check is not None:
        parts.append(f.check(c))
    if inner:
        fine = lambda x: reduce(lambda a, b: a & b, [holds(g, x[g.name]) for g in STRUCTS[inner]])
        parts.append(F.forall(c, fine) if f.kind.startswith("array") else fine(c))
    return F.when(c.isNull(), F.lit(f.null)).otherwise(F.coalesce(reduce(lambda a, b: a & b, parts, F.lit(True)), F.lit(False)))


def columns(df: DataFrame, kind: str) -> dict[str, Column]:
    """A kind's fields from the columns of df: what is absent or null takes the field's default, if it has one."""
    out = {}
    for f in ENTRIES[kind]:
        if f.name == "popularity_signals" and f.name not in df.columns:
            c = F.struct(*[(F.col(s) if s in df.columns else F.lit(None)).cast("bigint").alias(s) for s in SIGNALS])
        else:
            c = F.col(f.name).cast(spark_type(f.kind)) if f.name in df.columns else F.lit(None).cast(spark_type(f.kind))
        out[f.name] = c if f.default is ... or f.default is None or f.name == "popularity_signals" else F.coalesce(c, _literal(f))
    return out


def _literal(f: Field) -> Column:
    if f.default == []:
        return F.array().cast(spark_type(f.kind))
    return F.create_map().cast(f.kind) if f.default == {} else F.lit(f.default)


#: What no single field says, by the name of the violation.
CROSS = {
    "alias is canonical": lambda of: ~F.array_contains(of["alias_keys"], of["canonical_key"]),
    "repeated alias": lambda of: F.size(F.array_distinct(of["alias_keys"])) == F.size(of["alias_keys"]),
    "kind": lambda of: F.startswith(of["canonical_key"], F.concat(of["kind"], F.lit(":"))),
}


def violations(df: DataFrame) -> Column:
    """The names of what is wrong with an entry of df (columns as built, signals apart or together); a good one has none."""

    def wrong(kind: str) -> Column:
        of = columns(df, kind)
        named = [F.when(~holds(f, of[f.name]), F.lit(f.name)) for f in ENTRIES[kind] if f.name != "kind"]
        named += [F.when(~F.coalesce(ok(of), F.lit(False)), F.lit(name)) for name, ok in CROSS.items()]
        known = F.array(*[F.lit(f.name) for f in ENTRIES[kind]])
        named.append(F.when(F.size(F.array_except(of["curated_fields"], known)) > 0, F.lit("curated_fields")))
        return F.array_distinct(F.array_compact(F.array(*named)))

    return F.when(F.col("kind") == "mcp", wrong("mcp")).when(F.col("kind") == "skill", wrong("skill")).otherwise(F.array(F.lit("kind")))


def normalised(df: DataFrame) -> DataFrame:
    """Entries whose texts, tags and lists are in the form that entries have, whoever wrote them."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    sentence = lambda c: N.terminated(clean(text(c), N.NOTE - 1))
    tools = F.filter(F.transform("allowed_tools", lambda t: F.trim(t)), lambda t: (t != "") & (F.length(t) <= TOOL_NAME))
    put = {
        "name": collapse(text("name"), N.NAME), "description": collapse(text("description"), N.DESCRIPTION), "auth_note": sentence("auth_note"), "setup_note": sentence("setup_note"), "tags": N.tags(F.col("tags")), "popularity": S.rounded(F.col("popularity")),
        "alias_keys": F.slice(F.array_sort(F.array_distinct("alias_keys")), 1, N.ALIASES), "packages": F.slice(F.array_sort("packages"), 1, N.PACKAGES), "remotes": F.slice(F.array_sort("remotes"), 1, N.REMOTES),
        "allowed_tools": F.slice(F.array_sort(F.array_distinct(tools)), 1, TOOL_NAMES), "commit_sha": F.lower("commit_sha"), "curated_fields": F.array_sort(F.array_distinct("curated_fields")),
        "category": F.when(F.col("kind") == "skill", F.coalesce(F.nullif(collapse(text("category"), 64), F.lit("")), F.lit("General"))).otherwise(F.col("category")),
    }
    return df.withColumns({c: x for c, x in put.items() if c in df.columns})


def candidate_violations(df: DataFrame) -> Column:
    """The names of what is wrong with a candidate (kind, source_id, upstream_id, url, primary_key, keys, trust_hint)."""
    prefix = F.concat(F.col("kind"), F.lit(":"))
    ok = {
        "kind": F.col("kind").isin(*KINDS), "source_id": F.col("source_id") != "", "upstream_id": F.length("upstream_id").between(1, 300), "url": F.length("url").between(1, N.URL), "primary_key": F.col("primary_key").rlike(N.KEY_FORM),
        "keys": (F.size("keys") > 0) & F.forall("keys", lambda k: k.rlike(N.KEY_FORM)), "primary key is no key": F.array_contains("keys", F.col("primary_key")), "key of another kind": F.forall("keys", lambda k: F.startswith(k, prefix)), "trust_hint": F.col("trust_hint").isin(*S.TIERS),
    }
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in ok.items()]))


def merged_violations(df: DataFrame) -> Column:
    """The names of what is wrong with a fused component (kind, canonical_key, alias_keys, demoted_keys, sources, trust_tier)."""
    forms = lambda c: F.forall(c, lambda k: k.rlike(N.KEY_FORM))
    ok = {
        "kind": F.col("kind").isin(*KINDS), "canonical_key": F.col("canonical_key").rlike(N.KEY_FORM), "alias_keys": forms("alias_keys"), "demoted_keys": forms("demoted_keys"), "no candidate": F.size("sources") > 0,
        "alias is canonical": ~F.array_contains("alias_keys", F.col("canonical_key")), "trust_tier": F.col("trust_tier").isin(*S.TIERS),
    }
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in ok.items()]))


def mistyped(v: Column, at: str, t, null: bool, whole: bool = True) -> Column:
    """Whether what lies at a path of a VARIANT isn't of the type, at any depth; whole numbers may stand for doubles. Objects
    have all keys of their type if they have to be whole, else some, and never others."""
    got = F.try_variant_get(v, at, "variant")
    kind = F.coalesce(L.kind_of(got), F.lit("absent"))
    if isinstance(t, StructType):
        keys = F.array_sort(F.map_keys(F.coalesce(F.try_variant_get(got, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))))
        known = F.array(*[F.lit(f.name) for f in sorted(t.fields, key=lambda f: f.name)])
        inner = [(F.lit(whole) | F.array_contains(keys, f.name)) & mistyped(got, f"$['{f.name}']", f.dataType, f.name in SIGNALS, whole) for f in t.fields]
        bad = ~kind.startswith("OBJECT") | (keys != known if whole else F.size(F.array_except(keys, known)) > 0) | reduce(lambda a, b: a | b, inner)
    elif isinstance(t, ArrayType):
        items = F.coalesce(F.try_variant_get(got, "$", "array<variant>"), F.array().cast("array<variant>"))
        bad = ~kind.startswith("ARRAY") | F.exists(items, lambda x: mistyped(x, "$", t.elementType, False, whole))
    elif isinstance(t, MapType):
        values = F.map_values(F.coalesce(F.try_variant_get(got, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
        bad = ~kind.startswith("OBJECT") | F.exists(values, lambda x: L.kind_of(x) != "STRING")
    else:
        forms = {StringType: "^STRING$", BooleanType: "^BOOLEAN$", DoubleType: "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"}
        bad = ~kind.rlike(next((p for k, p in forms.items() if isinstance(t, k)), "^BIGINT$" if isinstance(t, IntegralType) else "^$"))
    return F.coalesce(bad, F.lit(True)) & ((kind != "VOID") if null else F.lit(True))


def line_faults(v: Column, kind: str) -> Column:
    """What keeps a line, parsed to a VARIANT, from being an entry of the kind: no JSON object, unknown, absent and mistyped
    keys, by name."""
    t = entry_type(kind)
    known = F.array(*[F.lit(f.name) for f in t.fields])
    keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    nullable = {f.name for f in ENTRIES[kind] if f.null}
    typed = [F.when(F.array_contains(keys, f.name) & mistyped(v, f"$['{f.name}']", f.dataType, f.name in nullable), F.lit(f"mistyped {f.name}")) for f in t.fields]
    unknown = F.transform(F.array_sort(F.array_except(keys, known)), lambda k: F.concat(F.lit("unknown "), k))
    absent = F.transform(F.array_except(known, keys), lambda k: F.concat(F.lit("absent "), k))
    return F.when(keys.isNull(), F.array(F.lit("not an entry"))).otherwise(F.concat(unknown, absent, F.array_compact(F.array(*typed))))


def checked_lines(df: DataFrame, kind: str) -> DataFrame:
    """df with faults, what keeps its line from being an entry; a line is parsed once, whatever is asked of it."""
    return df.withColumn("_v", F.try_parse_json("line")).withColumn("faults", line_faults(F.col("_v"), kind)).drop("_v")


def read_lines(df: DataFrame, kind: str) -> DataFrame:
    """df with entry, its line as a struct of the kind's type; only of lines without faults."""
    return checked_lines(df, kind).withColumn("entry", F.when(F.size("faults") == 0, F.from_json("line", entry_type(kind)))).drop("faults")


def _property(f: Field) -> dict:
    """A field as JSON Schema."""
    inner = next((n for n in STRUCTS if n in f.kind), None)
    base = {"bigint": "integer", "int": "integer", "double": "number", "boolean": "boolean", "string": "string"}
    if f.kind.startswith("array"):
        out = {"type": "array", "items": {"$ref": f"#/$defs/{inner}"} if inner else {"type": "string"} | ({"pattern": f.each} if f.each else {})}
        out |= ({"minItems": f.least} if f.least else {}) | ({"maxItems": f.most} if f.most is not None else {}) | ({"uniqueItems": True} if f.each else {})
    elif f.kind.startswith("map"):
        out = {"type": "object", "additionalProperties": {"type": "string"}} | ({"maxProperties": f.most} if f.most is not None else {})
    elif inner:
        out = {"$ref": f"#/$defs/{inner}"}
    else:
        low, high = ("minLength", "maxLength") if f.kind == "string" else ("minimum", "maximum")
        out = {"type": base[f.kind]} | ({low: f.least} if f.least is not None else {}) | ({high: f.most} if f.most is not None else {}) | ({"pattern": f.pattern} if f.pattern else {})
        if len(f.values) == 1:
            out |= {"const": f.values[0]}
        elif f.values and not f.null:
            out |= {"enum": list(f.values)}
    if f.null:
        out = {"anyOf": [out, {"type": "null"}]} | ({"enum": [*f.values, None]} if f.values else {})
    return out if f.default is ... else out | {"default": f.default}


def _definition(name: str, fields: list[Field]) -> dict:
    return {"additionalProperties": False, "properties": {f.name: _property(f) for f in fields}, "required": sorted(f.name for f in fields), "title": name, "type": "object"}


def json_schema(identity: str = "https://catalog.example/catalog.schema.json", title: str = "Catalog entry") -> str:
    """The JSON Schema of a line, indented and in order of keys: every field is required, since a line writes defaults too."""
    models = {"mcp": "McpEntry", "skill": "SkillEntry"}
    definitions = {n: _definition(n, f) for n, f in STRUCTS.items()} | {models[k]: _definition(models[k], f) for k, f in ENTRIES.items()}
    refs = {k: f"#/$defs/{m}" for k, m in models.items()}
    whole = {"$schema": DIALECT, "$id": identity, "title": title, "description": "One line of a published shard.", "$defs": definitions, "discriminator": {"mapping": refs, "propertyName": "kind"}, "oneOf": [{"$ref": r} for r in refs.values()]}
    return json.dumps(whole, indent=2, sort_keys=True, ensure_ascii=False) + "\n"
