"""String helpers with the source system's LEFT/RIGHT/LEN semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trimmed_length(s) -> Column:
    """Length ignoring trailing blanks."""
    return F.length(F.rtrim(_c(s)))


def parent_folder(path) -> Column:
    """Folder part of a catalog path, with its trailing slash.

    '/A/B/r1' -> '/A/B/', '/r2' -> '/', a path without a slash is returned whole.
    """
    p = _c(path)
    n = trimmed_length(p) - F.instr(F.reverse(p), "/") + 1
    return F.left(p, n)


def package_file_name(command, extension: str = ".dtsx", separator: str = "\\",
                      case_sensitive: bool = True) -> Column:
    """File name of a package inside a command line.

    The part between the last ``separator`` before the first ``extension`` and
    that extension, plus the extension. NULL when the command has no extension,
    or no separator before it. Case-insensitive mode finds ``.DTSX`` too.
    """
    c = _c(command)
    at = F.instr(c, extension) if case_sensitive else F.instr(F.lower(c), extension.lower())
    head = F.left(c, at - 1)
    name = F.concat(F.substring_index(head, separator, -1), F.lit(extension))
    ok = (at > 0) & (F.instr(head, separator) > 0)
    return F.when(ok, name)


def strip_domain(user, domain: str, case_sensitive: bool = True) -> Column:
    """Remove every occurrence of ``domain`` (e.g. ``'DOM\\\\'``) from a user name."""
    return text_replace(_c(user), domain, "", case_sensitive)


# Text tests with an optional collated mode. The source compares under a collation that ignores
# case and, in equality, join and group keys, trailing blanks; its LIKE ignores case but counts
# blanks. The default here is exact comparison.
KEY_COLLATION = "UTF8_LCASE_RTRIM"
PATTERN_COLLATION = "UTF8_LCASE"


def text_key(c, case_sensitive: bool = True) -> Column:
    """A text as a key of an equality, a join, a group or a sort."""
    return _c(c) if case_sensitive else F.collate(_c(c), KEY_COLLATION)


def _pattern_text(c, case_sensitive: bool) -> Column:
    return _c(c) if case_sensitive else F.collate(_c(c), PATTERN_COLLATION)


def text_equals(c, value: str, case_sensitive: bool = True) -> Column:
    return text_key(c, case_sensitive) == value


def text_startswith(c, prefix: str, case_sensitive: bool = True) -> Column:
    return _pattern_text(c, case_sensitive).startswith(prefix)


def text_like(c, pattern: str, case_sensitive: bool = True) -> Column:
    return _pattern_text(c, case_sensitive).like(pattern)


def text_contains(c, text: str, case_sensitive: bool = True) -> Column:
    return _pattern_text(c, case_sensitive).contains(text)


def text_replace(c, search: str, replacement: str, case_sensitive: bool = True) -> Column:
    c = _c(c)
    if case_sensitive:
        return F.replace(c, F.lit(search), F.lit(replacement))
    quoted = "(?i)\\Q" + search.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return F.regexp_replace(c, quoted, replacement.replace("\\", "\\\\").replace("$", "\\$"))


def html_escape(s) -> Column:
    """Escape text for an XML/HTML text node: &, <, > and the carriage return."""
    x = F.replace(_c(s), F.lit("&"), F.lit("&amp;"))
    x = F.replace(x, F.lit("<"), F.lit("&lt;"))
    x = F.replace(x, F.lit(">"), F.lit("&gt;"))
    return F.replace(x, F.lit("\r"), F.lit("&#x0D;"))
