"""String and list functions on peptide sequences and labels, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Modification masses as they are written in sequences, and their names.
MODIFICATIONS = {
    "15.9949": "Oxidation (M)",
    "57.0215": "Carbamidomethyl (C)",
    "57.02146": "Carbamidomethyl (C)",
    "42.0106": "Acetyl (Protein N-term)",
    "42.010565": "Acetyl (Protein N-term)",
    "-0.9840": "Amidated (C-term)",
    "-0.984016": "Amidated (C-term)",
}
#: Extensions of vendor files.
EXTENSIONS = ("raw", "d", "mzml", "mzxml", "wiff")


def strip_underscores(c: Column) -> Column:
    return F.regexp_replace(c, "^_+|_+$", "")


def strip_extension(c: Column) -> Column:
    """Trim, and drop one vendor extension in any case."""
    return F.regexp_replace(F.trim(c), rf"(?i)\.({'|'.join(EXTENSIONS)})$", "")


def _drop_modifications(c: Column) -> Column:
    for pattern in (r"^n\[[^\]]*\](?=[A-Z])", r"c\[[^\]]*\]$", r"\[[^\]]+\]"):
        c = F.regexp_replace(c, pattern, "")
    return c


def strip_modifications(c: Column) -> Column:
    """The bare sequence: no underscores at the ends, terminal tags, brackets or parentheses."""
    return F.translate(_drop_modifications(strip_underscores(c)), "()", "")


def name_numeric_modifications(c: Column, names: dict[str, str] = MODIFICATIONS) -> Column:
    """Replace masses after a residue or terminus by names.

    A mass counts as it is written, or if it equals a known one after rounding to 4, 5 or 6 decimals; others stay.
    Each bracket is looked at on its own: the text is cut after brackets, and each part's last mass is looked up.
    """
    part = r"([A-Znc])\[(-?\d+\.\d+)\]$"
    known = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))

    def named(x: Column) -> Column:
        mass = F.regexp_extract(x, part, 2)
        number = mass.try_cast("decimal(20,10)")
        spelled = [F.try_element_at(known, mass)] + [F.try_element_at(known, F.round(number, d).cast(f"decimal(20,{d})").cast("string")) for d in (4, 5, 6)]
        name = F.coalesce(*spelled)
        return F.when((mass != "") & name.isNotNull(), F.concat(F.regexp_replace(x, r"\[[^\]]*\]$", "["), name, F.lit("]"))).otherwise(x)

    return F.array_join(F.transform(F.split(c, r"(?<=\])"), named), "")


def peptide_index(c: Column, collapse_oxidation: bool = True, collapse_all: bool = False, name_numeric: bool = False) -> Column:
    """Identity of a peptide: oxidation of methionine, or every modification, may be dropped."""
    if name_numeric:
        c = name_numeric_modifications(c)
    c = strip_underscores(c)
    if collapse_oxidation:
        c = F.regexp_replace(c, r"M\[[^\]]*Oxidation[^\]]*\]", "M")
    return _drop_modifications(c) if collapse_all else c


def strip_brackets(c: Column) -> Column:
    """For the cleavage test: no brackets and no underscores at the ends."""
    return strip_underscores(F.regexp_replace(c, r"\[[^\]]*\]", ""))


def missed_cleavage(c: Column) -> Column:
    """Whether a lysine or arginine inside the sequence isn't followed by proline; null under two letters."""
    letters = F.regexp_replace(F.upper(strip_brackets(c)), "[^A-Z]", "")
    return F.when(F.length(letters) >= 2, letters.rlike("[KR][A-OQ-Z]"))


def first_part(c: Column) -> Column:
    """What stands before the first bar of a key; the whole of one without a bar."""
    return F.substring_index(c, "|", 1)


def first_double(c: Column) -> Column:
    """First token of a ;-list as a number; null where it is none."""
    return F.trim(F.get(F.split(c.cast("string"), ";"), F.lit(0))).try_cast("double")


def first_long(c: Column) -> Column:
    return first_double(c).try_cast("long")


def doubles(c: Column) -> Column:
    """A ;-list as an array of numbers, null where a token is none."""
    return F.transform(F.split(c, ";"), lambda x: F.trim(x).try_cast("double"))


def longs(c: Column) -> Column:
    return F.transform(F.split(F.trim(c), ";"), lambda x: F.trim(x).try_cast("long"))


def aligned(values: Column, like: Column) -> Column:
    """``values`` where it is as long as ``like``, else as many nulls."""
    return F.when(F.size(values) == F.size(like), values).otherwise(F.transform(like, lambda _: F.lit(None).cast("double")))


def sites(c: Column) -> Column:
    """All residues with their numbers, as S12."""
    return F.regexp_extract_all(c, F.lit(r"[STY]\d+"), F.lit(0))


def array_mean(c: Column) -> Column:
    """Mean of the numbers in an array; null without any."""
    there = F.filter(c, lambda x: x.isNotNull())
    return F.when(F.size(there) > 0, F.aggregate(there, F.lit(0.0), lambda a, x: a + x) / F.size(there))


def clean_label(c: Column) -> Column:
    """A condition's name as an identifier."""
    c = F.regexp_replace(F.trim(c), "[^A-Za-z0-9_]+", "_")
    return F.when(F.coalesce(c, F.lit("")) == "", "C_UNLABELED").when(c.rlike("^[0-9]"), F.concat(F.lit("C_"), c)).otherwise(c)


def contains_any(c: Column, tags: list[str]) -> Column:
    """Case-insensitive match of any tag."""
    found = F.lit(False)
    for tag in tags:
        found = found | F.contains(F.lower(c), F.lit(tag.lower()))
    return F.coalesce(found, F.lit(False))
