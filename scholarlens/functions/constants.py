"""Patterns, word lists and formats that results depend on."""

from __future__ import annotations

# Boilerplate of abstracts, removed in this order.
BOILERPLATE = [
    r"(?is)diajukan\s+(?:untuk|sebagai|guna)\s+memenuhi.*?(?:sarjana|magister|doktor|S1|S2|S3)",
    r"(?is)tugas\s+akhir\s+ini\s+diajukan.*?(?:persyaratan|syarat)",
    r"(?is)copyright\s*©?\s*(?:ITS|Institut Teknologi Sepuluh Nopember).*?\d{4}",
    r"(?is)hak\s+cipta\s+(?:dilindungi|milik).*?(?:undang-undang|ITS)",
    r"(?is)naskah\s+(?:skripsi|tesis|disertasi)\s+ini\s+(?:telah|sudah)\s+(?:disetujui|diperiksa)",
    r"(?is)program\s+studi\s+(?:sarjana|magister|doktor).*?(?:departemen|jurusan|fakultas)",
    r"(?is)this\s+(?:thesis|dissertation)\s+(?:is\s+)?submitted\s+(?:to|in\s+partial)",
    r"(?is)in\s+partial\s+fulfillment\s+of\s+the\s+requirements",
    r"(?is)copyright\s*©?\s*\d{4}.*?(?:all\s+rights\s+reserved)",
    r"(?is)approved\s+by\s+(?:the\s+)?(?:examining|thesis)\s+committee",
]
ABSTRACT_PREFIX = r"(?i)^(?:abstract|abstrak)\s*:?\s*"

# Supervisors named in an abstract.
ABSTRACT_SUPERVISORS = [
    r"(?i)(?:pembimbing|dosen\s+pembimbing)\s*(?:1|I|utama)?\s*:\s*([^\n\r,;]+)",
    r"(?i)(?:pembimbing|dosen\s+pembimbing)\s*(?:2|II|pendamping)?\s*:\s*([^\n\r,;]+)",
    r"(?i)supervisor\s*(?:1|I)?\s*:\s*([^\n\r,;]+)",
    r"(?i)supervisor\s*(?:2|II)?\s*:\s*([^\n\r,;]+)",
    r"(?i)advisor\s*(?:1|I)?\s*:\s*([^\n\r,;]+)",
    r"(?i)advisor\s*(?:2|II)?\s*:\s*([^\n\r,;]+)",
    r"(?i)co-?(?:advisor|supervisor)\s*:\s*([^\n\r,;]+)",
]
# Supervisors named anywhere in a title and abstract.
ANYWHERE_SUPERVISORS = [
    r"(?i)(?:dosen\s+)?pembimbing\s*(?:1|I|utama|pertama)?\s*[:\-]\s*([A-Z][^,\n\r]{5,60})",
    r"(?i)(?:dosen\s+)?pembimbing\s*(?:2|II|kedua|pendamping)?\s*[:\-]\s*([A-Z][^,\n\r]{5,60})",
    r"(?i)dibimbing\s+oleh\s*[:\-]?\s*([A-Z][^,\n\r]{5,60})",
    r"(?i)supervisor\s*(?:1|I)?\s*[:\-]\s*([A-Z][^,\n\r]{5,60})",
    r"(?i)supervisor\s*(?:2|II)?\s*[:\-]\s*([A-Z][^,\n\r]{5,60})",
    r"(?i)(?:thesis\s+)?advisor\s*(?:1|I)?\s*[:\-]\s*([A-Z][^,\n\r]{5,60})",
    r"(?i)co-?(?:advisor|supervisor)\s*[:\-]\s*([A-Z][^,\n\r]{5,60})",
    r"(?i)supervised\s+by\s*[:\-]?\s*([A-Z][^,\n\r]{5,60})",
    r"(?i)under\s+(?:the\s+)?(?:supervision|guidance)\s+of\s*[:\-]?\s*([A-Z][^,\n\r]{5,60})",
    r"(?i)(?:pembimbing|supervisor|advisor)[^:]*:\s*((?:Dr|Prof|Ir)\.\s*[A-Z][a-zA-Z\s,\.]{5,50})",
]
# Supervisors named on the first pages of a PDF.
PDF_SUPERVISORS = [
    r"(?i)dosen\s+pembimbing\s*(?:1|I|utama)?\s*[:\n\r]\s*([A-Z][^\n\r]{10,60})",
    r"(?i)dosen\s+pembimbing\s*(?:2|II|kedua)?\s*[:\n\r]\s*([A-Z][^\n\r]{10,60})",
    r"(?i)pembimbing\s*(?:1|I|utama)?\s*[:\n\r]\s*([A-Z][^\n\r]{10,60})",
    r"(?i)pembimbing\s*(?:2|II|kedua)?\s*[:\n\r]\s*([A-Z][^\n\r]{10,60})",
    r"(?i)((?:Dr|Prof|Ir)\.[^\n\r]{5,50})\s*NIP[:\.]?\s*\d{10,}",
    r"(?i)NIP[:\.]?\s*\d{10,}\s*[)\n\r]\s*([A-Z][^\n\r]{5,50})",
    r"(?i)(?:Disetujui|Approved)\s+oleh[:\n\r]\s*([A-Z][^\n\r]{10,60})",
    r"(?i)(?:Mengetahui|Menyetujui)[:\n\r]\s*(?:Dosen\s+Pembimbing)?[:\n\r]\s*([A-Z][^\n\r]{10,60})",
    r"(?i)supervisor[:\n\r]\s*([A-Z][^\n\r]{10,60})",
    r"(?i)thesis\s+advisor[:\n\r]\s*([A-Z][^\n\r]{10,60})",
    r"(?i)approved\s+by[:\n\r]\s*([A-Z][^\n\r]{10,60})",
]

# What is cut from a name, in order, for each of the three sources.
NAME_NOISE = {
    "abstract": [
        r"(?i)\(?(?:NIP|NRP|NIK)\s*:?\s*[\d\s.\-]+\)?",
        r"(?i)\b(?:pembimbing|supervisor|advisor)\b",
        r"^[\s\-:.,;]+|[\s\-:.,;]+$",
    ],
    "anywhere": [
        r"(?i)\(?(?:NIP|NRP|NIK)\s*:?\s*[\d\s.\-]+\)?",
        r"(?i)\b(?:pembimbing|supervisor|advisor|dosen)\b",
        r"(?i)\b(?:utama|pertama|kedua|pendamping)\b",
        r"^[\s\-:.,;]+|[\s\-:.,;0-9]+$",
    ],
    "pdf": [
        r"(?i)\(?NIP[:\.]?\s*[\d\s.\-]+\)?",
        r"(?i)\(?NIK[:\.]?\s*[\d\s.\-]+\)?",
        r"(?i)\b(?:pembimbing|supervisor|advisor|dosen|ketua|anggota)\b",
        r"(?i)\b(?:utama|pertama|kedua|pendamping|I|II)\b",
        r"^[\s\-:.,;()]+|[\s\-:.,;()0-9]+$",
    ],
}

# Sequences left by wrong decoding and what they stand for, replaced in this order.
MOJIBAKE = [
    ("â€™", "'"),
    ("â€œ", '"'),
    ("â€", '"'),
    ("Ã©", "é"),
    ("Ã¨", "è"),
    ("Ã ", "à"),
    ("�", ""),
    ("\x00", ""),
]

# The first of these words that a degree contains decides it.
DEGREES = [
    ("s1", "S1"), ("undergraduate", "S1"), ("sarjana", "S1"), ("bachelor", "S1"),
    ("s2", "S2"), ("master", "S2"), ("magister", "S2"),
    ("s3", "S3"), ("doctoral", "S3"), ("doktor", "S3"), ("phd", "S3"), ("dissertation", "S3"),
    ("d3", "D3"), ("diploma", "D3"), ("d4", "D4"),
]
# The same for record types and subjects.
RECORD_DEGREES = [("S1", ["s1", "undergraduate", "sarjana"]), ("S2", ["s2", "master", "magister"]), ("S3", ["s3", "doctoral", "doktor"]), ("S1", ["thesis"])]
# Words that name departments and supervisors, flags, fields, addresses, columns.
DEPT_WORDS = ["department", "departemen", "jurusan", "fakultas", "faculty"]
PAGE_DEPT_WORDS = ["department", "fakultas", "jurusan"]
SUPERVISOR_WORDS = ["pembimbing", "supervisor", "advisor"]
ABSTRACT_FLAGS = ["pembimbing", "supervisor", "advisor", "dosen"]
BIBTEX_FIELDS = ["editor", "contributor", "advisor", "supervisor"]
BASE_URL = "https://repository.its.ac.id"
EPRINT_ID = r"repository\.its\.ac\.id/(\d+)/?"
RECORD_LINK = r"^(?:https?://repository\.its\.ac\.id)?/\d{5,}/"
TITLE_SUFFIX = r"\s*-\s*ITS Repository$"
CSV_COLUMNS = ["title", "author", "abstract", "supervisors", "degree", "year", "dept", "url", "data_confidence"]
# Parts of messages that mean that the network is gone, and the file names of a record's PDF in the order
# in which they are tried ({id} is the record's number).
NETWORK_ERRORS = ["ERR_NAME_NOT_RESOLVED", "ERR_INTERNET_DISCONNECTED", "ERR_NETWORK_CHANGED", "ERR_CONNECTION_RESET", "ERR_CONNECTION_REFUSED", "net::ERR_"]
PDF_NAMES = ["{id}-Undergraduate_Thesis.pdf", "paper.pdf", "thesis.pdf"]
# Limits.
TITLE_MAX, AUTHOR_MAX, DEGREE_MAX, DEPT_MAX = 2000, 500, 50, 200
TEXT_MAX, MIN_ABSTRACT, MIN_YEAR = 8000, 50, 2015
PUBLICATIONS_MAX, ITEMS_MAX, TAGS_MAX = 50, 20, 10
TOTAL_LECTURERS = 1280
# What an expertise text says before a name, a department and the titles.
EXPERTISE = ("RETRIEVAL_DOCUMENT: Academic Expertise Profile of ", ", Department of ", ". Research Focus: ")
