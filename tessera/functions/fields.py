"""What single fields of catalog records may hold, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import collapse

# Bounds, patterns, domains and word lists.
NAME, DESCRIPTION, NOTE, URL = 120, 500, 500, 512
TAGS, TAG, SOURCES, ALIASES, PACKAGES, REMOTES, HEADERS, TOOLS = 20, 40, 8, 16, 8, 4, 8, 200
TAG_FORM = "^[a-z0-9][a-z0-9._-]*$"
SHA1 = "^[a-f0-9]{40}$"
SKILL_NAME = "^[a-z0-9](?:[a-z0-9-]{0,62}[a-z0-9])?$"
AVATAR = r"^https://github\.com/[A-Za-z0-9-]{1,39}\.png\?size=128$"
SERVER_ICON = r"^https://api\.smithery\.ai/servers/[^/?#\s]+(/[^/?#\s]+)*/icon$"
KEY_FORM = r"^(mcp|skill):[a-z0-9]+:[\x21-\x7e]{1,220}$"
SLUG_FORM = "^[a-z0-9_]{1,32}$"
SOURCE_IDS = ("curated", "registry", "smithery", "npm", "github_topics", "marketplaces")
TRANSPORTS = ("streamable_http", "sse", "unknown")
AUTH_HINTS = ("none", "bearer", "header", "oauth")
CONNECTORS = ("github", "linear", "supabase", "vercel", "http", "web", "mcp", "cli", "example")
ICONS = (
    "github linear vercel terminal mcp notebook message-square message-circle kanban credit-card users bug cloud life-buoy zap check-square palette "
    "pen-tool folder calendar mail table database globe hard-drive search web flame book-open send phone cpu flask"
).split()
CATEGORY_RULES = (
    ("Payments & commerce", "stripe|paypal|payment|invoice|billing|checkout|shopify|square|commerce"),
    ("CRM & support", "crm|salesforce|hubspot|zendesk|intercom|helpdesk|ticketing|support"),
    ("Design", "figma|canva|design|sketch|prototype|wireframe"),
    ("Project management", "jira|linear|asana|trello|clickup|monday|kanban|sprint|backlog|issue tracker|project management"),
    ("Communication", "slack|discord|telegram|email|gmail|smtp|sms|twilio|chat|messaging|resend"),
    ("Documents & knowledge", "notion|confluence|wiki|docs|document|markdown|pdf|knowledge base|obsidian"),
    ("Storage", "s3|dropbox|box|google drive|bucket|blob|filesystem|file storage"),
    ("Search & web", "search|browse|browser|scrape|crawl|serp|brave|tavily|exa|firecrawl|playwright|puppeteer|web"),
    ("Data & infrastructure", "postgres|postgresql|mysql|sqlite|database|warehouse|bigquery|snowflake|redis|kafka|kubernetes|terraform|aws|gcp|azure|cloudflare|supabase|neon"),
    ("Automation", "zapier|workflow|automation|n8n|cron|scheduler|pipeline"),
    ("Productivity", "calendar|todo|todoist|notes|reminder|task|productivity"),
    ("Developer tools", "github|gitlab|git|ci|cd|deploy|vercel|netlify|lint|test|debug|sentry|observability|sdk|compiler|ide"),
)
OTHER_CATEGORY = "Developer tools"
#: What notes call the program that connects to servers, and where records that people wrote say they come from.
CONSUMER, CURATED_URL = "This client", "https://catalog.example/curated"
CATEGORY_ICONS = {
    "Developer tools": "terminal", "Project management": "kanban", "Communication": "message-square", "Documents & knowledge": "notebook",
    "Payments & commerce": "credit-card", "CRM & support": "users", "Design": "palette", "Search & web": "search", "Data & infrastructure": "database",
    "Automation": "zap", "Productivity": "check-square", "Storage": "folder",
}
SLUG_ICONS = {
    "github": "github", "linear": "linear", "vercel": "vercel", "notion": "notebook", "slack": "message-square", "discord": "message-circle",
    "telegram": "send", "stripe": "credit-card", "paypal": "credit-card", "square": "credit-card", "hubspot": "users", "intercom": "life-buoy",
    "sentry": "bug", "cloudflare": "cloud", "zapier": "zap", "asana": "check-square", "monday": "kanban", "clickup": "kanban", "trello": "kanban",
    "todoist": "check-square", "canva": "palette", "figma": "pen-tool", "google_drive": "folder", "dropbox": "folder", "box": "folder",
    "google_calendar": "calendar", "gmail": "mail", "airtable": "table", "postgres": "database", "supabase": "database", "neon": "database",
    "filesystem": "hard-drive", "playwright": "globe", "brave_search": "search", "tavily": "search", "exa": "search", "firecrawl": "flame",
    "context7": "book-open", "huggingface": "cpu", "twilio": "phone", "resend": "mail", "deepwiki": "book-open", "microsoft_learn": "book-open", "http": "terminal",
}


def looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def https(url: Column) -> Column:
    """An https URL that is not too long, else empty."""
    plain = collapse(url, URL + 1)
    return F.when((F.length(plain) <= URL) & plain.startswith("https://"), plain).otherwise("")


def first_url(*urls: Column) -> Column:
    """The first http or https URL that is not too long, else empty."""
    plain = [collapse(u, URL + 1) for u in urls]
    return F.coalesce(*[F.when((F.length(p) <= URL) & p.rlike("^https?://"), p) for p in plain], F.lit(""))


def web_page(repo: Column) -> Column:
    return F.coalesce(F.concat(F.lit("https://"), F.concat_ws("/", repo["host"], repo["owner"], repo["repo"])), F.lit(""))


def tags(values: Column) -> Column:
    """At most 20 tags of the tag form, cut to 40 characters, distinct and sorted."""
    low = F.transform(values, lambda t: F.substring(F.lower(F.trim(t)), 1, TAG))
    return F.slice(F.array_sort(F.array_distinct(F.filter(low, lambda t: t.rlike(TAG_FORM)))), 1, TAGS)


def category(name: Column, description: Column, words: Column, extra: Column) -> Column:
    """The first rule with a whole word in name, description, tags or names of packages."""
    said = F.lower(F.concat_ws(" ", name, description, F.array_join(words, " "), extra))
    out = None
    for label, keywords in CATEGORY_RULES:
        found = said.rlike(rf"\b(?:{keywords})\b")
        out = F.when(found, label) if out is None else out.when(found, label)
    return out.otherwise(OTHER_CATEGORY)


def icon(slug: Column, category_: Column) -> Column:
    return F.coalesce(looked_up(SLUG_ICONS, slug), looked_up(CATEGORY_ICONS, category_), F.lit("mcp"))


def avatar(owner: Column) -> Column:
    """The picture of a GitHub owner, if the name can be one there; else empty."""
    url = F.concat(F.lit("https://github.com/"), F.lower(owner), F.lit(".png?size=128"))
    return F.when(url.rlike(AVATAR), url).otherwise("")


def icon_url(qualified_name: Column, repo: Column) -> Column:
    """A server's own icon, else its repository owner's picture, else empty."""
    own = F.concat(F.lit("https://api.smithery.ai/servers/"), qualified_name, F.lit("/icon"))
    own = F.when((qualified_name != "") & (F.length(own) <= URL) & own.rlike(SERVER_ICON), own)
    return F.coalesce(own, F.when(repo["host"] == "github.com", avatar(repo["owner"])), F.lit(""))


def stdio_note(identifier: Column, consumer: str = CONSUMER) -> Column:
    """What whoever connects has to do about a server that only runs as a local process; consumer: what they connect with."""
    return collapse(F.concat(F.lit(f"{consumer} does not spawn stdio servers. Host "), identifier, F.lit(" yourself and connect over HTTPS.")), NOTE)


def terminated(note: Column) -> Column:
    """A note as a sentence: a full stop at its end, unless it ends in one or in an address, which that would spoil."""
    return F.when((note == "") | note.endswith(".") | note.rlike(r"(?:https?://\S+|\b[\w.-]+:\d+\S*)$"), note).otherwise(F.concat(note, F.lit(".")))
