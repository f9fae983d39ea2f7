"""Kinds of files by their first bytes, in the words that archive methods and triage look for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes that a file's kind is told from; the mark of an ISO image lies last.
HEADER = 32_774

# Place (from 0) and bytes (hex) of marks, and the words for them.
MARKS = (
    (0, "504B0304", "Zip archive data"), (0, "504B0506", "Zip archive data (empty)"), (0, "526172211A07", "RAR archive data"), (0, "377ABCAF271C", "7-zip archive data"),
    (0, "1F8B", "gzip compressed data"), (0, "425A68", "bzip2 compressed data"), (0, "FD377A585A00", "XZ compressed data"), (0, "28B52FFD", "Zstandard compressed data"),
    (0, "1F9D", "compress'd data"), (0, "EDABEEDB", "RPM"), (0, "213C617263683E0A64656269616E", "Debian binary package"), (0, "4D534346", "Microsoft Cabinet archive data"),
    (0, "D0CF11E0A1B11AE1", "Composite Document File V2 Document"), (0, "68737173", "Squashfs filesystem, little endian"), (0, "78617221", "xar archive"),
    (0, "303730373031", "ASCII cpio archive"), (0, "303730373032", "ASCII cpio archive"), (0, "303730373037", "ASCII cpio archive"), (0, "C771", "cpio archive"),
    (257, "7573746172", "POSIX tar archive"), (32_769, "4344303031", "ISO 9660 CD-ROM filesystem data"),
)


def _at(content: Column, place: int, size: int) -> Column:
    return F.hex(F.substring(content, place + 1, size))


def magic(content: Column) -> Column:
    """Words for a binary column that begins with a file's first ``HEADER`` bytes; "data" for unknown kinds, "empty" without bytes."""
    elf_kind = F.when(_at(content, 5, 1) == "02", _at(content, 17, 1)).otherwise(_at(content, 16, 1))
    elf = F.concat(
        F.lit("ELF "), F.when(_at(content, 4, 1) == "02", "64-bit").otherwise("32-bit"), F.when(_at(content, 5, 1) == "02", " MSB ").otherwise(" LSB "),
        F.when(elf_kind == "01", "relocatable").when(elf_kind == "02", "executable").when(elf_kind == "03", "shared object").when(elf_kind == "04", "core file").otherwise("unknown"),
    )
    # little-endian place of the new header
    place = sum((F.conv(_at(content, 60 + k, 1), 16, 10).cast("long") * (1 << 8 * k) for k in range(4)), F.lit(0).cast("long"))
    near = (F.octet_length(content) >= 64) & (place < HEADER - 32)
    header = F.when(near, place.cast("int") + 1)
    sign = F.hex(F.substring(content, header, F.lit(4)))
    plus = F.hex(F.substring(content, header + 24, F.lit(2)))
    dos = F.when(sign == "50450000", F.when(plus == "0B02", "PE32+ executable").otherwise("PE32 executable")).otherwise("MS-DOS executable")
    out = F.when(F.coalesce(F.octet_length(content), F.lit(0)) == 0, "empty").when(_at(content, 0, 4) == "7F454C46", elf).when(_at(content, 0, 2) == "4D5A", dos)
    for place_, mark, words in MARKS:
        out = out.when(_at(content, place_, len(mark) // 2) == mark, words)
    return out.otherwise("data")


def executable(words: Column) -> Column:
    """ELF, PE32 or MSDOS for the words of an executable or shared object, else null."""
    dos = words.contains("MS-DOS executable")
    pe = words.contains("PE32 executable") | words.contains("PE32+ executable")
    elf = words.startswith("ELF") & (words.contains("executable") | words.contains("shared object"))
    return F.when(elf | pe | dos, F.when(dos, "MSDOS").when(pe, "PE32").otherwise("ELF"))
