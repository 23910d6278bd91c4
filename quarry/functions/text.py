"""Scalar text functions as Column expressions (JVM side, codegen-friendly).

Each function takes and returns ``pyspark.sql.Column``.  Regular expressions
use the ASCII classes that Java and RE2 share, so the DuckDB oracle spells
the same patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_WORD = "[^a-zA-Z0-9_]+"

# The stop words the search indexer skips (8 words).
INDEX_STOP_WORDS = ["the", "of", "to", "and", "a", "in", "is", "it"]

# Stop words dropped by the item-name normaliser.
ITEM_STOP_WORDS = ["a", "new", "some", "more", "my", "own", "the", "many", "other", "another"]

# Company-name suffixes removed in this order.
COMPANY_SUFFIXES = [", Inc.", ", Inc", ", LLC", ", LLP", " LLC", " Inc.", " Inc"]

# Job-title abbreviations expanded in this order.
TITLE_EXPANSIONS = [
    ("Sr.", "Senior"), ("Sr", "Senior"), ("Jr.", "Junior"), ("Jr", "Junior"),
    ("CEO", "Chief Executive Officer"), ("COO", "Chief Operating Officer"),
    ("CTO", "Chief Technology Officer"), ("CFO", "Chief Finance Officer"),
    ("VP", "Vice President"),
]

# Region-name words removed.
REGION_REMOVALS = ["Greater ", " Area"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """lower-case words split on non-word characters, empties dropped."""
    return F.filter(F.split(F.lower(_c(c)), NON_WORD), lambda x: x != F.lit(""))


def word_set(c, min_len: int = 3, max_len: int = 19) -> Column:
    """distinct lower-case words with min_len <= length <= max_len."""
    return F.array_distinct(F.filter(
        F.split(F.lower(_c(c)), NON_WORD),
        lambda x: (F.length(x) >= min_len) & (F.length(x) <= max_len)))


def long_words(c, min_len: int = 4) -> Column:
    """lower-case words longer than 3 characters, duplicates kept."""
    return F.filter(F.split(F.lower(_c(c)), NON_WORD), lambda x: F.length(x) >= min_len)


def letter_words(c) -> Column:
    """strip tags, split on non-letters, lower, drop empties."""
    stripped = F.regexp_replace(_c(c), "<[^>]+>", "")
    return F.filter(F.split(F.lower(stripped), "[^a-z]+"), lambda x: x != F.lit(""))


def strip_tags(c) -> Column:
    """text outside tags; each closed tag becomes a space and an unclosed
    tag swallows the rest of the text."""
    s = F.regexp_replace(_c(c), "<[^>]*>", " ")
    s = F.regexp_replace(s, "<[^>]*$", "")
    return F.regexp_replace(s, ">", " ")


def clean_html(c) -> Column:
    """drop script and style blocks, comments and tags, decode nbsp,
    squeeze double spaces (twice) and trim."""
    s = F.regexp_replace(_c(c), "(?is)<script[^>]*>.*?</script>", "")
    s = F.regexp_replace(s, "(?is)<style[^>]*>.*?</style>", "")
    s = F.regexp_replace(s, "(?s)<!--.*?-->", "")
    s = F.regexp_replace(s, "(?s)<[^>]*>", " ")
    s = F.regexp_replace(s, "&nbsp;", " ")
    s = F.regexp_replace(s, "  ", " ")
    s = F.regexp_replace(s, "  ", " ")
    return F.trim(s)


def item_name(c) -> Column:
    """lower, delete the characters ! .. . and &, drop stop words,
    join with spaces; null when shorter than 2 characters."""
    s = F.trim(F.regexp_replace(F.lower(_c(c)), "[!-.&]", ""))
    stop = F.array(*[F.lit(w) for w in ITEM_STOP_WORDS])
    kept = F.filter(F.split(s, " "), lambda x: ~F.array_contains(stop, x))
    out = F.array_join(kept, " ")
    return F.when(F.length(out) >= 2, out)


def replace_all(c, pairs) -> Column:
    """Ordered literal replacements (fold of F.replace)."""
    out = _c(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def company_name(c) -> Column:
    """company suffixes removed in order."""
    return replace_all(F.trim(_c(c)), [(s, "") for s in COMPANY_SUFFIXES])


def job_title(c) -> Column:
    """abbreviations expanded in order."""
    return replace_all(c, TITLE_EXPANSIONS)


def title_parts(c) -> Column:
    """split on '/', ' and ', '&'; trim; drop blanks."""
    parts = F.transform(F.split(_c(c), "/| and |&"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def slash_parts(c) -> Column:
    """split on '/', trim."""
    return F.transform(F.split(_c(c), "/"), lambda x: F.trim(x))


def capitalise(c) -> Column:
    """Python ``str.capitalize``: first character upper, rest lower."""
    c = _c(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def title_tokens(c) -> Column:
    """whitespace tokens, commas stripped, capitalised."""
    toks = F.filter(F.split(F.trim(_c(c)), "\\s+"), lambda x: x != F.lit(""))
    return F.transform(toks, lambda x: capitalise(F.btrim(x, F.lit(","))))


def region_name(c) -> Column:
    """F16: 'Greater ' and ' Area' removed."""
    return replace_all(c, [(s, "") for s in REGION_REMOVALS])


def state_code(c) -> Column:
    """last two adjacent capitals, else '???'."""
    code = F.regexp_extract(_c(c), ".*([A-Z]{2}).*", 1)
    return F.when(code == "", F.lit("???")).otherwise(code)


def recipients(c) -> Column:
    """remove newline, tab, CR and spaces, split on commas."""
    return F.split(F.regexp_replace(_c(c), "[\\n\\t\\r ]", ""), ",")


def hm_minutes(c) -> Column:
    """'H:MM' to minutes of the day."""
    parts = F.split(_c(c), ":")
    return parts.getItem(0).cast("int") * 60 + parts.getItem(1).cast("int")


def yes_no(c) -> Column:
    """yes 1, no -1, anything else 0."""
    c = _c(c)
    return F.when(c == "yes", 1).when(c == "no", -1).otherwise(0)


def interest_overlap(a, b) -> Column:
    """items of list a (':'-separated) present in list b, duplicates in
    a counted."""
    lb = F.split(_c(b), ":")
    return F.size(F.filter(F.split(_c(a), ":"), lambda x: F.array_contains(lb, x)))


def miles(lat1, lon1, lat2, lon2) -> Column:
    """flat-earth miles: sqrt((69.1 dlat)^2 + (53 dlon)^2)."""
    dlat = 69.1 * (_c(lat2) - _c(lat1))
    dlon = 53.0 * (_c(lon2) - _c(lon1))
    return F.sqrt(dlat * dlat + dlon * dlon)


def ws_tokens(c) -> Column:
    """Whitespace tokens (used by Jaccard distance and TF)."""
    return F.filter(F.split(_c(c), "\\s+"), lambda x: x != F.lit(""))


def jaccard_distance(a, b) -> Column:
    """1 - |A n B| / |A u B| of two token arrays (sets)."""
    a, b = _c(a), _c(b)
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.lit(1.0) - F.try_divide(inter.cast("double"), union.cast("double"))


def entry_text(publisher, title, summary) -> Column:
    """publisher, title and summary joined by newlines."""
    return F.concat_ws("\n", _c(publisher), _c(title), _c(summary))


def entry_features(title, summary, publisher) -> Column:
    """'Title:w' per title word, summary words (and adjacent pairs),
    'Publisher:p', and an UPPERCASE flag when over 30 % of summary words are
    upper case (tested before lower-casing)."""
    tw = F.filter(F.split(F.lower(_c(title)), "\\s+"), lambda x: (F.length(x) > 2) & (F.length(x) < 20))
    raw = F.filter(F.split(_c(summary), "\\s+"), lambda x: (F.length(x) > 2) & (F.length(x) < 20))
    sw = F.transform(raw, lambda x: F.lower(x))
    n_upper = F.size(F.filter(raw, lambda x: (x == F.upper(x)) & (x != F.lower(x))))
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(sw) - 2, F.lit(-1))),
                        lambda i: F.concat_ws(" ", F.element_at(sw, i + 1), F.element_at(sw, i + 2)))
    pairs = F.when(F.size(sw) >= 2, pairs).otherwise(F.array().cast("array<string>"))
    feats = F.array_union(F.transform(tw, lambda x: F.concat(F.lit("Title:"), x)),
                          F.array_union(sw, pairs))
    feats = F.array_union(feats, F.array(F.concat(F.lit("Publisher:"), _c(publisher))))
    upper_flag = F.when((F.size(sw) > 0) & (n_upper / F.size(sw) > 0.3),
                        F.array(F.lit("UPPERCASE"))).otherwise(F.array().cast("array<string>"))
    return F.array_union(feats, upper_flag)


# The English stop-word list of the reference's text toolkit
# (127 words, in its order).
ENGLISH_STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing a an the
and but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here there
when where why how all any both each few more most other some such no nor not only own same so than
too very s t can will just don should now""".split()

# Word and punctuation tokens (letters of any script count as word chars).
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
SENTENCE_PATTERN = r"[^.!?\n]+[.!?]*"


def lower_ws_tokens(c) -> Column:
    """lower().split(): lower-case whitespace tokens."""
    return F.filter(F.split(F.lower(_c(c)), "\\s+"), lambda x: x != F.lit(""))


def sentences(c) -> Column:
    """sentences: runs up to a closing . ! or ? (or a line end), trimmed,
    keeping only those with a letter or digit."""
    parts = F.transform(F.regexp_extract_all(_c(c), F.lit(SENTENCE_PATTERN), 0), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x.rlike("[\\p{L}\\p{N}]"))


def tokens(c) -> Column:
    """word and punctuation tokens of a text."""
    return F.regexp_extract_all(_c(c), F.lit(TOKEN_PATTERN), 0)


def visible_text(c) -> Column:
    """F8: every text node of a page joined by newlines: tags become line
    breaks; comment and declaration bodies count as text; entities stay."""
    s = F.regexp_replace(_c(c), "(?s)<!--(.*?)-->", "\n$1\n")
    s = F.regexp_replace(s, "<!([^>]*)>", "\n$1\n")
    return F.regexp_replace(s, "<[^>]*>", "\n")


def _char(code: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _numeric_entity(digits: Column, base: int) -> Column:
    """Text of a numeric character reference by the rules of HTML: C1 numbers
    stand for Windows-1252 characters, impossible ones for U+FFFD, controls and
    non-characters for nothing."""
    # nine significant digits are enough to be out of range
    short = F.regexp_replace(digits, "^0+", "")
    n = F.when(F.length(short) > 9, F.lit(0x110000)).otherwise(F.coalesce(F.conv(F.when(short == "", "0").otherwise(short), base, 10).cast("long"), F.lit(0)))
    c1 = {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)} | {0x00: "\ufffd", 0x0D: "\r"}
    table = F.create_map(*[F.lit(x) for kv in c1.items() for x in kv])
    control = ((n < 0x20) & ~n.isin(0x09, 0x0A, 0x0C)) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF) | (n == 0x0B) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return (F.when(n.isin(*c1), F.try_element_at(table, n.cast("int")))
            .when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").when(control, "").otherwise(_char(n)))


def html_unescape(c) -> Column:
    """character references to characters, null to ''.  The text is cut
    into references and what lies between; names come from the standard
    library's table of HTML names, as a literal map, and a name without its
    semicolon is taken by its longest known beginning."""
    from html.entities import html5

    closed = F.create_map(*[F.lit(x) for k, v in html5.items() if k.endswith(";") for x in (k, v)])
    bare = sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
    open_ = F.create_map(*[F.lit(x) for k in bare for x in (k, html5[k])])
    head = "^(" + "|".join(bare) + ")"

    def one(p: Column) -> Column:
        name = F.substring(p, 2, 1 << 30)
        start = F.regexp_extract(name, head, 1)
        named = F.coalesce(F.try_element_at(closed, name), F.when(start != "", F.concat(F.try_element_at(open_, start), F.substr(name, F.length(start) + 1))), p)
        hexed, dec = F.regexp_extract(p, "^&#[xX]([0-9a-fA-F]+)", 1), F.regexp_extract(p, "^&#([0-9]+)", 1)
        return (F.when(~p.startswith("&"), p).when(hexed != "", _numeric_entity(hexed, 16))
                .when(dec != "", _numeric_entity(dec, 10)).otherwise(named))

    pieces = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit("&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[a-zA-Z0-9]+;?|[^&]+|&"), F.lit(0))
    return F.array_join(F.transform(pieces, one), "")


def quoted_printable(c) -> Column:
    """Quoted-printable to text: soft line breaks go, =XX are bytes of UTF-8."""
    s = F.regexp_replace(_c(c), "=[ \\t]*\\r?\\n", "")
    pieces = F.regexp_extract_all(s, F.lit("(?:=[0-9A-Fa-f]{2})+|[^=]+|="), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(
        p.rlike("^(?:=[0-9A-Fa-f]{2})+$"), F.try_to_binary(F.replace(p, F.lit("="), F.lit("")), F.lit("hex")).cast("string")).otherwise(p)), "")


def mail_body(c) -> Column:
    """a quoted-printable HTML body as the text of its nodes; '' for null."""
    return F.coalesce(html_unescape(F.regexp_replace(visible_text(quoted_printable(c)), "\n+", "\n")), F.lit(""))


def mail_date(c) -> Column:
    """A mail date with its offset (weekday and trailing comment may be there)."""
    s = F.regexp_replace(F.regexp_replace(_c(c), r"\s*\([^)]*\)\s*$", ""), r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm Z")))


def mail_epoch_ms(c) -> Column:
    """a mail date as milliseconds since 1970."""
    return F.unix_millis(mail_date(c))


def geo(c) -> tuple[Column, Column]:
    """latitude and longitude of the first element of class geo, given
    as ``lat; lon`` or by child elements of class latitude and longitude."""
    number = r"(-?[0-9]+(?:\.[0-9]+)?)"
    inner = r"(?s)<[^>]*class=\"geo\"[^>]*>"
    both = inner + rf"\s*{number}\s*;\s*{number}"

    def part(i: int, name: str) -> Column:
        child = inner + rf".*?class=\"{name}\"[^>]*>\s*{number}"
        return F.coalesce(F.nullif(F.regexp_extract(_c(c), both, i), F.lit("")), F.nullif(F.regexp_extract(_c(c), child, 1), F.lit(""))).cast("double")

    return part(1, "latitude"), part(2, "longitude")
