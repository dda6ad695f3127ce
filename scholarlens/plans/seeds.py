"""Example texts that queries put before or after a row's own text, one for each row by its key."""

DEPTS = ["Informatics", "", "Physics", "Informatics", "Physics"]
SPACED = ["a \t b\n\n\n\n c  \n", "  x\t\ty \n \n \n\nz\n", "plain ", "\n\n\n\n\t"]
MOJIBAKE = ["itâ€™s ", "â€œquotedâ€ ", "cafÃ© Ã¨ Ã  ", "a\x07b�c ", "plain "]
BOILERPLATE = [
    "Diajukan untuk memenuhi persyaratan gelar Sarjana teknik. ",
    "Copyright © 2019 by the author. All rights reserved. ",
    "This thesis is submitted to the faculty in partial fulfillment of the requirements for it. ",
    "Hak cipta dilindungi oleh\nundang-undang. Naskah skripsi ini telah disetujui. ",
    "Approved by the examining committee. Program studi magister teknik departemen ",
    "nothing of the kind ",
]
PREFIXES = ["Abstract: ", "ABSTRAK ", "abstraction is key ", "An abstract: ", "abstract"]
SUPERVISORS = [
    "Pembimbing I : Dr. Ana Budi, M.T.\n",
    "Supervisor: Prof. Carl Dewi\nCo-advisor: Ir. Eka Fitri; x\n",
    "advisor 1: john lowercase name\n",
    "Dosen Pembimbing utama: Dr. Gita Hadi (NIP 19700101 199903 1 001)\n",
    "Dibimbing oleh Prof. Indra Jaya\nSupervised by: Kiki Lala\n",
    "Pembimbing: Dr. Ana Budi\nSupervisor: DR. ANA BUDI\nAdvisor 2 : Ir. Mira Nur\n",
    "nobody is named here\n",
]
PDF = [
    "\nDosen Pembimbing :\nDr. Ana Budi Setiawan\nNIP. 197001011999031001\n",
    "\nProf. Carl Dewi Lestari NIP: 196512121990021002\nApproved by:\nEka Fitri Handayani\n",
    "\nsupervisor: john lowercase name\nThesis advisor: Gita Hadi Pratama\n",
    "\nMengetahui:\nDosen Pembimbing:\nIndra Jaya Kusuma\n",
    "\nnothing here\n",
]
BIBTEX = [
    "@phdthesis{a1, editor = {Dr. Ana Budi and Carl Dewi}, title = {x}} ",
    "@misc{b2,\n advisor={Eka Fitri and Dr. Gita Hadi and Indra Jaya},\n year={2001}} ",
    '@misc{c3, supervisor = "Kiki Lala", contributor = {kiki lala and X}} ',
    "@misc{d4, title={no one}} ",
]
DEGREES = ["Pascasarjana", "Master of X", "PhD", "Diploma", "Postgraduate", "", " s2 ", "Undergraduate Thesis", "D4 terapan"]
TYPES = ["Master Thesis", "Thesis", "Article", "Undergraduate", "Doctoral Dissertation"]
SUBJECTS = ["Fakultas Teknik", "Mathematics", "Department of Physics", "jurusan mesin", ""]
ITEMS = ["Smart grids in 2019\nshort\nAn item of research (1998)\n", "tiny\n      padded title 2031 \n", "\n\n2017 and 2018\n"]
H_INDEX = ["H-Index\t34\t45\nNIDN : 0012345678", "h index   7", "H-Index\tnone\nh-index\t3", "no index here\nNIDN:0098765432", "Score  H-Index  12  15  18"]
INFLECTED = [
    "Pembelajaran mesin untuk perbaikan bukunya ",
    "mempelajari kebersamaan, memukul dan menyapu ",
    "Dipelajari: bacalah makanan penyakit pertanian ",
    "keadilan bekerja belajar pelajar pelajaran ",
    "no such words ",
]
LINKS = [
    '<a href="2019.html">x</a><a class="l" href=\'http://y.org/2020.html\'>y</a><a href="2019.html">x</a> Page 2 of 17 ',
    '<A HREF="/111537/">r</A><a href="https://repository.its.ac.id/22222/">s</a><a href="/1/">t</a><a href="/111537/">r</a> ',
    "none ",
]
#: Heads of pages, and the fields that each makes of the page that follows (None: as the page itself has it).
PAGES = [
    (
        '<html><head><meta name="citation_author" content="Ana Budi"><meta name="citation_date" content="2017/05"><meta name="citation_advisor" content=" Dr. Carl Dewi "><meta name="DC.supervisor" content="Eka Fitri"></head>'
        '<h1>Smart &amp; small grids - ITS Repository</h1><h2>Abstract</h2><p>On <i>grids</i>.</p><a href="/view/divisions/ee/">Department of Physics</a><a href="/view/degree/S2/">S2 Theses</a><a href="/9/1/a.PDF">x</a>',
        {"title": "Smart & small grids", "author": "Ana Budi", "year": 2017, "abstract": "Ongrids.", "supervisors": "Dr. Carl Dewi|Eka Fitri", "dept": "Department of Physics", "degree": "S2", "pdf_url": "https://repository.its.ac.id/9/1/a.PDF"},
    ),
    (
        "<title>Waves</title><p>Gita Hadi, Indra (2009) Waves.</p><table><tr><td>Dosen Pembimbing</td><td>Kiki Lala</td></tr><tr><th>Supervisor</th><td>Mira Nur</td></tr><tr><td>Advisor 2</td><td>Omar P</td></tr></table><div class='x Abstract-text'>In short</div>",
        {"title": None, "author": "Gita Hadi, Indra", "year": 2009, "abstract": "In short", "supervisors": "Kiki Lala|Mira Nur", "dept": "", "degree": "", "pdf_url": None},
    ),
    (
        "<h3>Abstrak</h3><div><p>Ringkas</div><a href='/view/divisions/x/'>Office</a><a href='/view/divisions/y/'>Fakultas Teknik</a><a href='/view/Doctoral/'>Doctoral list</a><a href='http://z.org/b.pdf'>pdf</a>",
        {"title": None, "author": "Unknown", "year": None, "abstract": "Ringkas", "supervisors": "", "dept": "Fakultas Teknik", "degree": "S3", "pdf_url": "http://z.org/b.pdf"},
    ),
    ("", {"title": None, "author": "Unknown", "year": None, "abstract": "", "supervisors": "", "dept": "", "degree": "", "pdf_url": None}),
]
