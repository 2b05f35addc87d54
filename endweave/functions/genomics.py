"""Column functions on alignments, coordinates and sequences (0-based, half-open)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Alignment flag bits.
PAIRED, UNMAPPED, REVERSE, READ1, READ2, SECONDARY, DUPLICATE, SUPPLEMENTARY = 1, 4, 16, 64, 128, 256, 1024, 2048
#: poly(A) signal hexamers, in order of priority.
MOTIFS = ("AATAAA", "ATTAAA", "AGTAAA", "TATAAA", "CATAAA", "GATAAA", "AATATA", "AATACA")


def flagged(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) != 0


def transcript_strand(flag: Column) -> Column:
    """A reverse read comes from the plus strand of the transcript."""
    return F.when(flagged(flag, REVERSE), "+").otherwise("-")


def transcript_end(flag: Column, start: Column, end: Column) -> Column:
    return F.when(flagged(flag, REVERSE), end - 1).otherwise(start)


def end_clipped(flag: Column, cigar: Column, hard: bool = True) -> Column:
    """Whether the read is clipped on the side that defines the transcript's end."""
    ops = "[SH]" if hard else "S"
    return F.when(flagged(flag, REVERSE), cigar.rlike(f"{ops}$")).otherwise(cigar.rlike(f"^[0-9]+{ops}"))


def defines_end(flag: Column, layout: Column) -> Column:
    """Every single-end read, and the first read of a pair."""
    return (layout != "PE") | (flagged(flag, PAIRED) & flagged(flag, READ1))


def mapping_class(flag: Column, nh: Column, compatible: bool = False) -> Column:
    unique = F.lit(True) if compatible else F.coalesce(nh, F.lit(0)) == 1
    return (
        F.when(flagged(flag, UNMAPPED), "unmapped")
        .when(flagged(flag, SECONDARY), "secondary")
        .when(flagged(flag, SUPPLEMENTARY), "supplementary")
        .when(~unique, "multimapping_or_missing_NH")
        .otherwise("eligible_primary")
    )


def is_c0(flag: Column, nh: Column) -> Column:
    return ~flagged(flag, UNMAPPED | SECONDARY | SUPPLEMENTARY) & (F.coalesce(nh, F.lit(0)) == 1)


def strand_selected(flag: Column, layout: Column, strand: str) -> Column:
    """Reads that cover the transcript's strand: for pairs the first read reversed or the second forward."""
    reverse = flagged(flag, REVERSE)
    first, second = flagged(flag, READ1), flagged(flag, READ2)
    plus = F.when(layout == "PE", (first & reverse) | (second & ~reverse)).otherwise(reverse)
    minus = F.when(layout == "PE", (first & ~reverse) | (second & reverse)).otherwise(~reverse)
    return plus if strand == "+" else minus


def centered(position: Column, width: int, length: Column) -> tuple[Column, Column]:
    """An even width has one position more after the centre than before it; clipped at both ends."""
    lower = (width - 1) // 2
    return F.greatest(F.lit(0), position - lower), F.least(length, position + (width - lower))


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(sequence, "ACGTNacgtn", "TGCANtgcan"))


def base_run(sequence: Column, base: str) -> Column:
    """The longest run of a base."""
    runs = F.regexp_extract_all(sequence, F.lit(f"({base}+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def count_base(sequence: Column, base: str) -> Column:
    return F.length(sequence) - F.length(F.replace(sequence, F.lit(base), F.lit("")))


def internal_priming(sequence: Column, position: Column, strand: Column, run: int = 6, window: int = 10, least: int = 7) -> Column:
    """Whether a window with the position in it is A-rich (T-rich on the minus strand): ``run`` bases
    of only A, or ``window`` bases with ``least``. Windows stay inside the sequence."""
    base = F.when(strand == "+", "A").otherwise("T")

    def any_window(width: int, test) -> Column:
        first = F.greatest(F.lit(0), position - width + 1)
        last = F.least(position, F.length(sequence) - width)
        starts = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.exists(starts, lambda o: test(F.substring(sequence, o + 1, F.lit(width))))

    def pure(part: Column) -> Column:
        return part == F.repeat(base, F.lit(run))

    def rich(part: Column) -> Column:
        return F.length(part) - F.length(F.replace(part, base, F.lit(""))) >= least

    return any_window(run, pure) | any_window(window, rich)


def a_rich(sequence: Column, share: float = 0.7, run: int = 6) -> Column:
    """Downstream A-richness of whole sequences."""
    return (count_base(sequence, "A") >= share * F.length(sequence)) | (base_run(sequence, "A") >= run)


def a_rich_trigger(sequence: Column, least: int = 12, run: int = 6) -> Column:
    """A missing sequence counts as A-rich."""
    return F.coalesce((count_base(sequence, "A") >= least) | sequence.contains("A" * run), F.lit(True))


def first_motif(sequence: Column) -> Column:
    """The motif of the highest priority that occurs, wherever it does."""
    return F.coalesce(*[F.when(sequence.contains(m), F.lit(m)) for m in MOTIFS])


def unversioned(identifier: Column) -> Column:
    return F.regexp_replace(identifier, "[.][0-9]+$", "")


def checksum_seed(text: Column, modulus: int = 2147483647) -> Column:
    """Code points weighted by their place, 1 based."""
    chars = F.split(text, "")
    return F.pmod(
        F.aggregate(
            F.transform(chars, lambda c, i: F.ascii(c).cast("long") * (i + 1)), F.lit(0).cast("long"), lambda a, x: a + x
        ),
        F.lit(modulus),
    ).cast("long")


def finite(value: Column) -> Column:
    """'', NA, NaN and infinities are null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def attribute(text: Column, key: str) -> Column:
    """The last value of a key in annotation attributes ``key "value";``, null without one."""
    found = F.regexp_extract_all(text, F.lit(rf'(?:^|;)\s*{key} "?([^";]*)"?'), F.lit(1))
    return F.when(F.size(found) > 0, F.element_at(found, -1))
