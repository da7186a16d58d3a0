"""Normal forms of organization names and titles, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrille.functions.scalars import strip_accents

#: Words that an organization's normal form leaves out. Fixed values.
ORGANIZATION_STOP_WORDS = ("the", "of", "for", "from", "on", "a", "an")

#: Upper case, dots and hyphens, with one to nine letters.
_ABBREVIATION = r"^[.\-]*(?:\p{javaUpperCase}[.\-]*){1,9}$"


def is_abbreviation(token: Column) -> Column:
    return token.rlike(_ABBREVIATION)


def organization(label: Column) -> Column:
    """struct(form, abbreviation) of an organization's label; a label without abbreviation has null there, a null label is null.

    Abbreviation: the label if it is one; else ABC where the first word is 'ABC-word' and the label isn't all capitals (the word then stands for the first one). A last word that
    begins with '(' and is an abbreviation without its punctuation is one too: it follows the other after a space, and leaves the form.
    Form: the words but for stop words; one that is '&' is 'and'; of others, all characters but ASCII letters, digits and '_' go, so that accented letters vanish; in lower case.
    """
    words = F.split(F.regexp_replace(label, " +$", ""), " ")
    first, last, n = F.get(words, 0), F.get(words, F.size(words) - 1), F.size(words)
    halves = F.split(F.regexp_replace(first, "-+$", ""), "-")
    prefixed = (label != F.upper(label)) & (F.size(halves) == 2) & is_abbreviation(F.get(halves, 0)) & ~is_abbreviation(F.get(halves, 1))
    named = F.when((n == 1) & is_abbreviation(first), first).when(prefixed, F.get(halves, 0))
    begin = F.when(prefixed, F.get(halves, 1)).otherwise(first)
    ending = F.when(n == 1, begin).otherwise(last)
    bare = F.regexp_replace(ending, r"[^A-Za-z0-9_]", "")
    closing = ending.startswith("(") & is_abbreviation(bare)
    rest = F.concat(F.array(begin), F.slice(words, 2, n))
    kept = F.when(closing, F.slice(rest, 1, n - 1)).otherwise(rest)
    plain = F.transform(kept, lambda w: F.when(w == "&", "and").otherwise(F.lower(F.regexp_replace(w, r"[^A-Za-z0-9_]", ""))))
    form = F.array_join(F.filter(plain, lambda w: (w != "") & ~w.isin(*ORGANIZATION_STOP_WORDS)), " ")
    short = F.when(named.isNotNull() & closing, F.concat(named, F.lit(" "), bare)).when(closing, bare).otherwise(named)
    return F.when(label.isNotNull(), F.struct(form.alias("form"), short.alias("abbreviation")))


def title(label: Column) -> Column:
    """The form of a journal's, concept's or work's title: hyphens are spaces, words in brackets go, lower case without accents; a word '&' is 'and'."""
    words = F.filter(F.split(F.regexp_replace(label, "-", " "), " "), lambda t: (t != "") & ~(t.startswith("[") & t.endswith("]")))
    plain = F.transform(words, lambda t: F.regexp_replace(strip_accents(F.lower(t)), r"^[\x00-\x20]+|[\x00-\x20]+$", ""))
    return F.array_join(F.transform(F.filter(plain, lambda t: t != ""), lambda t: F.when(t == "&", "and").otherwise(t)), " ")
