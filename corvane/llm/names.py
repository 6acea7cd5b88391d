"""One spelling for split, source and author values that are written in many ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of the three splits.
SPLIT_NAMES = {
    "train": ["train", "training"],
    "val": ["val", "valid", "validation", "dev"],
    "test": ["test", "testing"],
}

# Texts that stand for "not known" and link nothing.
STAND_INS = [
    "", "-", "--", "?", ".", "n/a", "na", "n.a.", "nan", "nil", "none", "null", "unknown", "not known",
    "unknown author", "author unknown", "unbekannt", "anonymous", "anon", "anonym", "anonyme", "anónimo",
    "inconnu", "desconocido", "undefined", "unspecified", "no author", "various", "tbd", "todo",
]

# Web hosts of the source families.
FAMILY_HOSTS = {
    "github": ["git.example", "github.com", "raw.githubusercontent.com"],
    "arxiv": ["papers.example", "arxiv.org"],
    "wikimedia": ["media.example", "commons.wikimedia.org"],
}
FAMILIES = ["github", "arxiv", "wikimedia", "commoncrawl", "synthetic"]

_ACCENTED = "àáâãäåāçćčèéêëēìíîïīñńòóôõöøōùúûüūýÿšžß"
_PLAIN = "aaaaaaaccceeeeeiiiiinnooooooouuuuuyyszs"


def fold(value: Column) -> Column:
    """Lower case without accents or outer white space."""
    return F.translate(F.lower(F.regexp_replace(value, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), _ACCENTED, _PLAIN)


def split_name(value: Column) -> Column:
    """train, val or test; null for a blank or any other value."""
    plain = fold(value)
    out = F.lit(None).cast("string")
    for name, spellings in SPLIT_NAMES.items():
        out = F.when(plain.isin(spellings), F.lit(name)).otherwise(out)
    return out


def known(value: Column) -> Column:
    """The value, or null where it is blank or stands for "not known"."""
    return F.when(value.isNull() | fold(value).isin(STAND_INS), None).otherwise(value)


def source_key(value: Column) -> Column:
    """``family:name`` of a repository, paper, category, site or batch; null if unknown.

    Schemes, hosts of a known family, version suffixes, ``.git``, ``www.``, paths below
    a site, letter case and the choice of separator do not matter.
    """
    text = F.regexp_replace(fold(known(value)), r"[?#].*$", "")
    for family, hosts in FAMILY_HOSTS.items():
        for host in hosts:
            place = r"^(?:https?://(?:www\.)?|git@|ssh://git@)" + host.replace(".", r"\.") + r"[/:]+(?:abs/|pdf/|wiki/)?"
            text = F.regexp_replace(text, place, family + ":")
    text = F.regexp_replace(text, r"^https?://", "commoncrawl:")
    family = F.regexp_extract(text, r"^(" + "|".join(FAMILIES) + r")\s*[:/]", 1)
    rest = F.regexp_replace(text, r"^(?:" + "|".join(FAMILIES) + r")\s*[:/]\s*", "")
    rest = F.regexp_replace(rest, r"/+$", "")
    name = (
        F.when(family == "github", F.regexp_replace(rest, r"\.git$", ""))
        .when(family == "arxiv", F.regexp_replace(F.regexp_replace(rest, r"\.pdf$", ""), r"v\d+$", ""))
        .when(family == "wikimedia", F.regexp_replace(rest, r"^category:", ""))
        .when(family == "commoncrawl", F.regexp_replace(F.regexp_replace(rest, r"^www\.", ""), r"[/:].*$", ""))
        .otherwise(rest)
    )
    name = F.regexp_replace(name, r"[\s_-]+", "-")
    return F.when(F.length(name) > 0, F.concat(F.when(family == "", F.lit("other")).otherwise(family), F.lit(":"), name))


def author_key(value: Column) -> Column:
    """The words of a name in order of the alphabet; null if unknown.

    Handles (``@first-last``), ``last_first``, ``Last, First``, a mail address behind
    the name, accents, case and spacing do not matter.
    """
    text = F.regexp_replace(fold(known(value)), r"<[^>]*>", " ")
    text = F.regexp_replace(text, r"(?<=\w)@[\w.-]+$", "")
    words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    name = F.array_join(F.array_sort(words), " ")
    return F.when(F.length(name) > 0, name)


def plain_source(value: Column) -> Column:
    """A document source with one spelling: lower case, words joined by hyphens; null if blank."""
    name = F.regexp_replace(fold(value), r"[\s_-]+", "-")
    return F.when(F.length(name) > 0, name)
