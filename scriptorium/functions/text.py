"""Text functions as Spark columns: keys, slugs, similarity, repairs, search scores. Null in gives null out."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accented Latin letters and what they fold to
ACCENTED = "àáâãäåèéêëìíîïòóôõöùúûüçñýÿ"
FOLDED = "aaaaaaeeeeiiiiooooouuuucnyy"
# fixed values: words a search ignores
STOP_WORDS = ("di", "il", "la", "lo", "le", "un", "una", "del", "della", "dei", "delle", "degli", "e", "da", "in", "con", "per", "su", "gli", "al", "alla", "che", "nel", "nella")


def fold(c: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(c), ACCENTED, FOLDED)


def name_key(c: Column) -> Column:
    """Lower case, runs of other than letters, digits and _ as one blank, trimmed; accents stay."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", " "))


def letters_key(c: Column) -> Column:
    """Only a-z and 0-9, accents folded."""
    return F.regexp_replace(fold(c), "[^a-z0-9]", "")


def bare_name(c: Column) -> Column:
    """Folded, without brackets and what is in them, single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(fold(c), r"\([^)]*\)", ""), r"\s+", " "))


def ascii_words(c: Column) -> Column:
    """Folded words of a-z and 0-9 with single blanks."""
    return F.trim(F.regexp_replace(fold(c), "[^a-z0-9]+", " "))


def line_key(c: Column) -> Column:
    """For matching lines: without tags, markup signs, blanks and dots at the end."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(c), "<[^>]*>", ""), r"[#*_`|>\s]+", ""), r"\.+$", "")


def heading_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def margin_key(c: Column) -> Column:
    """For lines repeated in margins: digits as one #, single blanks."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"\d+", "#"), r"\s+", " ")


def book_slug(c: Column) -> Column:
    """a-z, 0-9 and dashes; trimmed before the cut at 60."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, 60)


def chapter_slug(c: Column) -> Column:
    """Like book_slug with accents folded and dots kept; one dash goes from either side."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.translate(F.lower(c), "àáâäèéêëìíîïòóôöùúûü", "aaaaeeeeiiiioooouuuu"), "[^a-z0-9.]+", "-"), "^-|-$", ""), 1, 60)


def similarity(a: Column, b: Column) -> Column:
    """Graded likeness of a title a and a line b: equal, b begins with a, a near the start of b, alike without blanks, few letters changed."""
    tight_a, tight_b = F.replace(a, F.lit(" "), F.lit("")), F.replace(b, F.lit(" "), F.lit(""))
    at = F.instr(b, a)
    few = F.greatest(F.lit(1), F.floor(F.length(a) * 0.08))
    return (
        F.when(F.coalesce(a, F.lit("")).eqNullSafe("") | F.coalesce(b, F.lit("")).eqNullSafe(""), 0.0)
        .when(a == b, 1.0)
        .when(F.startswith(b, a), 0.95)
        .when((at > 0) & (at <= 61), 0.85)
        .when((tight_a != "") & F.startswith(tight_b, tight_a), 0.90)
        .when((F.length(a) >= 12) & (F.abs(F.length(a) - F.length(b)) <= 3) & (F.levenshtein(a, b) <= few), 0.88)
        .otherwise(0.0)
    )


def title_variants(c: Column) -> Column:
    """A title, and both parts of one written "A - B"."""
    at = F.instr(c, " - ")
    return F.when(at > 0, F.array(ascii_words(c), ascii_words(F.substring(c, F.lit(1), at - 1)), ascii_words(F.substring(c, at + 3, F.length(c))))).when(c.isNotNull(), F.array(ascii_words(c)))


def last_year(c: Column) -> Column:
    """The last year 19xx or 20xx that stands alone in a name."""
    return F.try_element_at(F.regexp_extract_all(c, F.lit(r"(?<!\d)((?:19|20)\d{2})(?!\d)"), F.lit(1)), F.lit(-1)).cast("int")


def chapter_title(text: Column, otherwise: Column) -> Column:
    """The first heading of level 1 to 3 in the first 12 lines, else a readable file name."""
    head = F.slice(F.split(text, "\n"), 1, 12)
    found = F.filter(head, lambda line: line.rlike(r"^#{1,3}\s+\S"))
    return F.when(F.size(found) > 0, F.trim(F.regexp_replace(F.try_element_at(found, F.lit(1)), r"^#{1,3}\s+", ""))).otherwise(otherwise)


def image_links(c: Column, base: str) -> Column:
    """Relative image links of Markdown made absolute."""
    return F.regexp_replace(c, r"!\[([^\]]*)\]\((?!https?:)([^)]+)\)", "![$1](" + base + "$2)")


def occurrences(text: Column, term: str) -> Column:
    """How often a literal occurs, not overlapping."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / len(term)).cast("int")


def search_terms(query: str) -> tuple[list[str], str, bool]:
    """Terms (no stop words unless there are no others, six at most), phrase, and whether the phrase counts."""
    phrase = " ".join(query.strip().lower().split())
    whole = [w for w in phrase.split(" ") if len(w) > 1]
    return ([w for w in whole if w not in STOP_WORDS] or whole)[:6], phrase, len(whole) > 1


def plain_text(c: Column) -> Column:
    """Text for snippets: no tags, no markup signs, single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"[#*_`|]+", " "), r"\s+", " "))


def snippet(plain: Column, terms: list[str]) -> Column:
    """190 characters from 70 before the first term."""
    places = [F.when(F.instr(F.lower(plain), t) > 0, F.instr(F.lower(plain), t)) for t in terms]
    first = F.least(*places, F.lit(2147483647)) if len(places) > 1 else F.coalesce(places[0], F.lit(1))
    first = F.when(first == 2147483647, 1).otherwise(first)
    return F.substring(plain, F.greatest(F.lit(1), first - 70), F.lit(190))


# fixed values: dice with letters read for digits (l and I for 1, o and O for 0): quantities from 1 to 20, faces that exist
DICE = r"\b(?:[1-9lI]|[0oO][1-9lI]|[1lI][0-9lIoO]|2[0oO])?[dD](?:[0oO]{0,2}[23468]|[0oO]?(?:[1lI][0oO]|[1lI]2|2[0oO])|[1lI][0oO][0oO])\b"


def repair_dice(c: Column) -> Column:
    """dl2 -> d12, 2dlO -> 2d10 where quantity and faces are valid; other words stay."""
    gaps, dice = F.split(c, DICE, -1), F.regexp_extract_all(c, F.lit(DICE), F.lit(0))
    return F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.translate(F.get(dice, i), "lIoO", "1100"), F.lit("")))), "")


def browser(ua: Column) -> Column:
    """Browser/system of a user agent."""
    def first(cases: tuple[tuple[str, str], ...], otherwise: Column) -> Column:
        out = otherwise
        for pattern, name in reversed(cases):
            out = F.when(ua.rlike(pattern), name).otherwise(out)
        return out

    program = first((("Edg/", "Edge"), ("OPR/|Opera", "Opera"), ("Firefox/", "Firefox"), ("Chrome/", "Chrome"), ("Safari/", "Safari")), F.when(ua == "", "-").otherwise("altro"))
    system = first((("Windows", "Windows"), ("Android", "Android"), ("iPhone|iPad|iOS", "iOS"), ("Mac OS X|Macintosh", "macOS"), ("Linux", "Linux")), F.lit("-"))
    return F.concat(program, F.lit("/"), system)


def merged(left: Column, right: Column) -> Column:
    """Two maps as one; the right one wins."""
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k)), right)


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Keyed hash of a text, as hexadecimal digits."""
    block = (key if len(key) <= 64 else hashlib.sha256(key).digest()).ljust(64, b"\0")
    inner = F.sha2(F.concat(F.lit(bytes(b ^ 0x36 for b in block)), message.cast("binary")), 256)
    return F.sha2(F.concat(F.lit(bytes(b ^ 0x5C for b in block)), F.unhex(inner)), 256)


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """Name-based identifier (version 5)."""
    h = F.sha1(F.concat(F.lit(namespace.bytes), name.cast("binary")))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), F.translate(part(17, 1), "0123456789abcdef", "89ab" * 4), part(18, 3), F.lit("-"), part(21, 12))


def dotted_contents(c: Column) -> Column:
    """A line of a table of contents: dot leaders in front of a number, or several leaders."""
    return c.rlike(r"\.{4,}\s*\d+\s*$") | (F.regexp_count(c, F.lit(r"(?:\.\s?){4,}")) >= 2)


def functional_end(c: Column) -> Column:
    """A line that ends in an article or preposition goes on in the next."""
    return F.lower(c).rlike(r"(?:^|\s)(?:di|a|da|in|con|su|per|tra|fra|il|lo|la|i|gli|le|un|una|del|della|dei|delle|al|alla|e|o)\s*$")


def only_numbers(c: Column) -> Column:
    return c.rlike(r"^[\d\s.,;:/+\-–—()]+$")


def dice_header(c: Column) -> Column:
    return F.lower(c).rlike(r"^\s*\d*d(?:4|6|8|10|12|20|100)\b")


def rooms_code(c: Column) -> Column:
    return c.rlike(r"^[A-Z]?\d{1,3}[a-z]?[.:]\s")


def capital(c: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))


def list_of(c: Column) -> Column:
    """Parts between commas, trimmed, capitalised, none empty."""
    return F.filter(F.transform(F.split(c, ","), lambda x: capital(F.trim(x))), lambda x: x != "")


def ocr_maths(c: Column) -> Column:
    """Degrees and superscripts of OCR, soft hyphens and no-break blanks."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\$\s*(\d+)\s*\^\{?\\circ\}?\s*\$", "$1°"), "­", ""), " ", " ")


def rejoin(c: Column) -> Column:
    """Line ends inside a sentence become blanks: no end mark before, lower case after."""
    return F.regexp_replace(c, r"([^.!?:;\n])\n(?=\p{Ll})", "$1 ")


def page_breaks(c: Column) -> Column:
    """Pages joined by a ruled line made one text: cut words and broken sentences joined, blank lines collapsed."""
    out = F.regexp_replace(c, r"(\p{L})-\n+---\n+(\p{Ll})", "$1$2")
    out = F.regexp_replace(out, r"([^.!?:\n])\n+---\n+(\p{Ll})", "$1 $2")
    return F.regexp_replace(F.regexp_replace(out, r"\n+---\n+", "\n\n"), r"\n{3,}", "\n\n")


def unfenced(c: Column) -> Column:
    """A model's answer without its code fence."""
    return F.btrim(F.regexp_replace(c, r"(?m)^\s*```(?:json)?\s*$", ""), F.lit(" \t\r\n"))


def salvaged_names(c: Column) -> Column:
    """Values of "nome" in a text that may be cut off."""
    return F.regexp_extract_all(c, F.lit(r'"nome"\s*:\s*"([^"]*)"'), F.lit(1))


def html_lines(c: Column) -> Column:
    """Non-empty lines of a text whose tags count as line ends."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, "<[^>]*>", "\n"), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def dialogue(c: Column) -> Column:
    """At least half of the lines begin with a name and a colon."""
    lines = F.filter(F.split(c, "\n"), lambda x: F.trim(x) != "")
    return (F.size(F.filter(lines, lambda x: x.rlike(r"^\p{Lu}[\p{L}' ]{0,30}:"))) * 2 >= F.size(lines)) & (F.size(lines) > 0)


def letter_share(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}]", "")) / F.greatest(F.length(c), F.lit(1))


def table_width(c: Column) -> Column:
    """Width class of a text's first table row: t8, t11 or t14 from so many columns on, cells that span several counted as such."""
    cells = F.regexp_extract_all(F.lower(F.regexp_extract(c, r"(?is)<tr[^>]*>(.*?)</tr>", 1)), F.lit("<t[dh][^>]*>"), F.lit(0))
    n = F.aggregate(F.transform(cells, lambda x: F.coalesce(F.regexp_extract(x, "colspan=[^0-9]{0,1}([0-9]+)", 1).try_cast("int"), F.lit(1))), F.lit(0), lambda a, b: a + b)
    return F.when(n >= 14, "t14").when(n >= 11, "t11").when(n >= 8, "t8").otherwise("")


def mime(c: Column) -> Column:
    """Media type of a file name."""
    end = F.lower(F.regexp_extract(c, r"\.([A-Za-z0-9]+)$", 1))
    kinds = {"md": "text/markdown", "json": "application/json", "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif", "webp": "image/webp", "pdf": "application/pdf", "epub": "application/epub+zip"}
    out = F.lit("application/octet-stream")
    for k, v in kinds.items():
        out = F.when(end == k, v).otherwise(out)
    return out


def safe_name(c: Column) -> Column:
    """A project name without path parts."""
    return c.rlike(r"^[\p{L}\p{N}][\p{L}\p{N} ._'()\-]*$") & ~F.contains(c, F.lit(".."))


def shingles(c: Column, n: int = 3) -> Column:
    """Distinct character n-grams of a name padded with blanks."""
    p = F.concat(F.lit("  "), c, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(p) - (n - 1)), lambda i: F.substring(p, i, F.lit(n))))
