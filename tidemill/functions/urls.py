"""URL columns. URLs are read with regular expressions: Spark's URI parser refuses addresses that venues really use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an address may look like.
COURSE_URL = r"^https?://[A-Za-z0-9.-]+(:[0-9]{1,5})?([/?][A-Za-z0-9._~/?=%+,:@-]*)?$"
SITEMAP_URL = r"^https?://[A-Za-z0-9._~:/?#@=%+,-]+$"
DOTTED_HOST = r"^(?=.{1,253}$)[a-z0-9]([a-z0-9-]*[a-z0-9])?([.][a-z0-9]([a-z0-9-]*[a-z0-9])?)+$"
LINK_SAFE = r"[A-Za-z0-9:/?#@!$&'+,;=%~._-]"
VIDEO_URL = r"""^https?://[^\s<>"'()\[\]\\`]+$"""
PLAYER_PATH = r"^https://[A-Za-z0-9.-]+/v/[0-9]+/id/[0-9]+([?].*)?$"
ENTITY_TYPES = ("album", "artist", "episode", "playlist", "show", "track")
LONGEST = 2000
TRACKING = ("hslang",)


def _part(url: Column, n: int) -> Column:
    """1 scheme, 2 netloc, 3 path, 4 query, 5 fragment; empty where there is none."""
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)(?:[?]([^#]*))?(?:#(.*))?$", n)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def netloc(url: Column) -> Column:
    return _part(url, 2)


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def host(url: Column) -> Column:
    """Lowered, without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(netloc(url), r"^.*@", ""), r":[0-9]*$", ""))


def bare_host(url: Column) -> Column:
    """host without one leading www."""
    return F.regexp_replace(host(url), r"^www[.]", "")


def netloc_host(url: Column) -> Column:
    """The share variant: netloc without www., its port kept."""
    return F.regexp_replace(F.lower(netloc(url)), r"^www[.]", "")


def registered(url: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host(url), ".", -2)


def host_suffixes(url: Column) -> Column:
    """The host and each domain above it but the last label; a single label is itself; none for no host."""
    labels = F.split(host(url), "[.]", -1)
    n = F.size(labels)
    made = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.when(host(url) == "", F.array().cast("array<string>")).otherwise(made)


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"#.*$", "")


def clean_course(url: Column) -> Column:
    """A safe http(s) address, scheme lowered and fragment dropped; null for anything else."""
    bare = F.trim(url)
    made = F.concat(F.lower(F.regexp_extract(bare, r"^([A-Za-z]+):", 1)), F.regexp_replace(F.regexp_replace(bare, r"#.*$", ""), r"^[A-Za-z]+:", ":"))
    port = F.regexp_extract(netloc(made), r":([0-9]+)$", 1)
    ok = made.rlike(COURSE_URL) & (F.char_length(made) <= LONGEST) & ~netloc(made).contains("@") & (F.coalesce(port.try_cast("int"), F.lit(0)) <= 65535)
    return F.when(ok, made)


def safe_sitemap(url: Column) -> Column:
    """The address unchanged if a shell, a link and an attribute read all of it as text, its host has dotted labels and its port is one; else null."""
    port = F.regexp_extract(netloc(url), r":([0-9]+)$", 1)
    return F.when(url.rlike(SITEMAP_URL) & host(url).rlike(DOTTED_HOST) & (F.coalesce(port.try_cast("int"), F.when(port == "", 0).otherwise(F.lit(65536))) <= 65535), url)


def link_target(url: Column) -> Column:
    """The address with each character that could end a link, a cell or a tag percent-encoded."""
    coded = lambda ch: F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", r"%$1")
    return F.array_join(F.transform(F.split(url, "", -1), lambda ch: F.when((ch == "") | ch.rlike(f"^{LINK_SAFE}$"), ch).otherwise(coded(ch))), "")


def http_url(url: Column) -> Column:
    """Trimmed, if it has a scheme http(s), a host and no white space or unprintable character, else null."""
    bare = F.trim(url)
    return F.when(bare.rlike(r"^(?i:https?)://[^/?#\p{C}\p{Z}]+[^\p{C}\p{Z}]*$"), bare)


def clean_video(url: Column) -> Column:
    return F.when(url.rlike(VIDEO_URL), url)


def is_http(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^(?i:https?)://[^/?#]+"), F.lit(False))


def player_url(url: Column, hosts: list[str], with_query: bool = False) -> Column:
    """An https player address of one of the hosts; a query only where allowed."""
    ok = url.rlike(PLAYER_PATH) & host(url).isin(hosts)
    return F.when(ok if with_query else ok & ~url.contains("?"), url)


def same_key(url: Column) -> Column:
    """What two spellings of a page share: scheme and host lowered, no trailing slashes, query kept, no fragment."""
    q = query(url)
    return F.concat(scheme(url), F.lit("://"), F.lower(netloc(url)), F.regexp_replace(path(url), r"/+$", ""), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))


def normalized(url: Column, strip: tuple[str, ...] = ()) -> Column:
    """One spelling a page: parameters of TRACKING and strip dropped by name, no fragment, scheme and host lowered, no
    trailing slash but the root's. Parameters without a value get an empty one."""
    names = [n.lower() for n in (*TRACKING, *strip)]
    pairs = F.filter(F.split(query(url), "&", -1), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(names))
    kept = F.array_join(F.transform(pairs, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("=")))), "&")
    short = F.regexp_replace(path(url), r"/+$", "")
    root = F.when(short == "", F.lit("/")).otherwise(short)
    return F.concat(scheme(url), F.lit("://"), F.lower(netloc(url)), root, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def entity(address: Column, n: int) -> Column:
    """1 type, 2 id of an entity's address (URI or URL; embed and intl-.. segments are passed over), null for others."""
    found = F.regexp_extract(address, rf"^(?:[a-z]+:|https?://[^/?#]+/(?:(?:embed|intl-[a-z]+)/)*)({'|'.join(ENTITY_TYPES)})[:/]([A-Za-z0-9]{{1,64}})(?:[/?#].*)?$", n)
    return F.nullif(found, F.lit(""))


def entity_url(kind: Column, ident: Column, origin: str) -> Column:
    return F.concat(F.lit(origin + "/"), kind, F.lit("/"), ident)


def redacted(text: Column, cap: int = 200) -> Column:
    """Unsafe characters as _, cut."""
    return F.left(F.regexp_replace(text, r"[^A-Za-z0-9._~/?=%+,:@-]", "_"), F.lit(cap))


def comma_escaped(url: Column) -> Column:
    return F.replace(url, F.lit(","), F.lit("%2C"))


def hash8(text: Column) -> Column:
    """The first eight hex digits of the SHA-1 of the text's UTF-8."""
    return F.substring(F.sha1(F.encode(text, "UTF-8")), 1, 8)


def slug(text: Column, cap: int = 60, fallback: str = "item") -> Column:
    """Lower letters and digits joined by -, cut; a - that the cut leaves at the end stays."""
    made = F.left(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(cap))
    return F.when(made == "", F.lit(fallback)).otherwise(made)


def share_slug(text: Column, cap: int = 60, fallback: str = "item") -> Column:
    """slug, without a - at the end after the cut."""
    made = F.regexp_replace(F.left(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(cap)), "-+$", "")
    return F.when(made == "", F.lit(fallback)).otherwise(made)


def leaf_dir(folder: str, url: Column) -> Column:
    """_raw/folder/slug of the path's segments (or of the host)--hash8."""
    segments = F.regexp_replace(F.regexp_replace(path(url), "/+", "-"), "^-+|-+$", "")
    named = F.when(segments == "", F.lower(netloc(url))).otherwise(segments)
    return F.concat(F.lit(f"_raw/{folder}/"), slug(named), F.lit("--"), hash8(url))


def page_path_ok(path_: Column) -> Column:
    """A relative, printable .md path without .. and without names that begin with a dot."""
    return path_.rlike(r"^[^\p{C}]+[.]md$") & ~path_.rlike(r"(^|/)[.]") & ~path_.startswith("/") & ~path_.contains("\\")


def glob_pattern(pattern: str, classes: bool = True) -> str:
    """A shell pattern as a regular expression: * and ?, and [..] where classes is true; all case matters."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        i += 1
        if c == "*":
            out += ".*"
        elif c == "?" and classes:
            out += "."
        elif c == "[" and classes and "]" in pattern[i + 1 :]:
            j = pattern.index("]", i + 1)
            inner = pattern[i:j].replace("\\", "\\\\")
            out += "[" + ("^" + inner[1:] if inner[0] == "!" else inner) + "]"
            i = j + 1
        else:
            out += "[" + c + "]" if c in ".+?()|{}$*" else "\\" + c if c in "^[]\\" else c
    return f"^(?s:{out})$"
