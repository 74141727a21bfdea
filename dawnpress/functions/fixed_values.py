"""Vocabularies, limits and patterns that decide results. They are data, stated as they are."""


# -- fixed values: titles and clustering
STOP_WORDS = [
    "yang", "dan", "di", "ke", "dari", "untuk", "pada", "dengan", "ini", "itu", "akan", "ada", "tidak", "bisa", "dalam", "juga", "sudah", "atau", "karena",
    "oleh", "saat", "hingga", "usai", "jadi", "lebih", "masih", "para", "agar", "soal", "buat", "kata", "ujar", "sebut", "menjadi", "adalah", "telah", "resmi",
    "simak", "begini", "berikut", "terbaru", "terkini", "video", "foto", "live", "update", "hari", "kini", "baru", "jelang", "pagi", "siang", "sore", "malam",
    "dini", "kemarin", "besok", "sesi", "level", "posisi", "poin", "persen", "anjak", "tutup", "dibuka", "the", "a", "an", "of", "to", "in", "on", "for",
    "and", "is", "as", "at", "by", "with", "from", "its", "it", "be", "are", "was", "will", "has", "after", "over", "amid", "says", "say", "new",
]
PREFIXES = ["memper", "menper", "diper", "keter", "peng", "peny", "pem", "pen", "per", "mem", "men", "meng", "meny", "ter", "ber", "me", "di", "ke", "se", "pe"]
SUFFIXES = ["kannya", "annya", "inya", "nya", "kan", "lah", "kah", "an", "i"]
STEM_REST, STEM_LEAST = 4, 3
NOT_TOKEN = "[^0-9a-zA-ZÀ-ɏ]+"
THRESHOLD, AI_THRESHOLD, LEAST_TOKENS, HOT_TOKEN = 0.42, 0.25, 3, 60
RARE_SHARED, RARE_OVERLAP, RARE_SHARE, RARE_LEAST = 3, 0.5, 0.025, 10

# -- fixed values: ingest
DROPPED_PARAMS = ["utm_", "fbclid", "gclid", "ref", "source"]
SUMMARY_CHARS = 400
IMAGE_ENDS = [".jpg", ".jpeg", ".png", ".webp", ".gif", ".avif"]
TRACKERS = ["doubleclick", "/pixel", "1x1", "spacer", "blank.gif", "feedburner"]
RETRY_STATUS = [408, 425, 429, 500, 502, 503, 504]

# -- fixed values: editions
SECTION_LIMITS = {"makro": 12, "pajak": 10, "pasar": 10, "politik": 6, "global": 8, "ai": 8}
TOP_LIMIT, TOP_SECTION = 6, "utama"
SECTIONS = {
    "utama": ("Penting Pagi Ini", "dampak tinggi, lintas bagian"),
    "makro": ("Makro & Kebijakan", "BPS, BI, APBN, kurs, regulasi"),
    "pajak": ("Perpajakan", "DJP, Coretax, PPN/PPh, bea cukai, aturan baru"),
    "pasar": ("Pasar & Emiten", "IHSG, aksi korporasi, laporan keuangan"),
    "politik": ("Politik & Sosial", "yang berpotensi menggerakkan pasar"),
    "global": ("Global", "The Fed, komoditas, geopolitik"),
    "ai": ("AI", "model baru, chip, pendanaan, regulasi, dampak ke pekerjaan"),
}
MONTHS = ["Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September", "Oktober", "November", "Desember"]
DAYS = ["Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu"]
SHORT_DAYS = ["Sn", "Sl", "Rb", "Km", "Jm", "Sb", "Mg"]
SHORTCUTS = [(1, "Kemarin"), (3, "3 hari lalu"), (7, "Seminggu lalu"), (14, "2 minggu lalu"), (30, "Sebulan lalu")]
BADGES = {"positif": "↑", "negatif": "↓"}
POLITICS_WORDS = [
    "kebijakan", "pemerintah", "presiden", "wapres", "menteri", "kementerian", "dpr", "dpd", "mpr", "ruu", "undang", "perpres", "perppu", "permen", "pp",
    "kabinet", "apbn", "apbd", "anggaran", "pajak", "cukai", "subsidi", "bansos", "tarif", "impor", "ekspor", "bumn", "regulasi", "aturan", "izin", "moneter",
    "fiskal", "ekonomi", "investasi", "industri", "perdagangan", "upah", "buruh", "demo", "unjuk", "mogok", "pemilu", "pilkada", "koalisi", "reshuffle",
    "korupsi", "kpk", "kejaksaan", "ojk", "bi", "sri", "purbaya", "prabowo", "utang", "defisit", "inflasi", "rupiah", "pertamina", "pln", "energi", "pangan",
    "beras", "bbm", "sawit", "nikel", "tambang", "infrastruktur", "karhutla", "bencana", "banjir", "gempa", "erupsi", "phk", "mbg", "gaji", "ump", "umk",
    "listrik", "harga", "bpjs", "kesehatan", "pendidikan",
]
CENTRAL_BANKS = ["federalreserve.gov", "ecb.europa.eu"]
CENTRAL_BANK_WORDS = ["decision", "decisions", "statement", "fomc", "minutes", "monetary", "rate", "rates", "policy", "projections", "press", "conference"]

# -- fixed values: impact
WIDE_MEDIA, SOME_MEDIA, PRIMARY_WEIGHT = 5, 2, 2.0
BIG_PHRASES = {
    "Kebijakan moneter": [
        "bi rate", "bi7drr", "suku bunga acuan", "rapat dewan gubernur", "bank sentral", "the fed", "fomc", "federal reserve", "pelonggaran moneter",
        "pengetatan moneter",
    ],
    "Data makro": [
        "inflasi", "deflasi", "produk domestik bruto", "neraca dagang", "neraca perdagangan", "cadangan devisa", "transaksi berjalan", "pmi manufaktur",
        "angka pengangguran",
    ],
    "Fiskal & pajak": [
        "apbn", "defisit anggaran", "utang negara", "tarif ppn", "ppn naik", "pph badan", "kenaikan cukai", "bea masuk", "tarif impor", "subsidi bbm",
        "subsidi energi",
    ],
    "Komoditas & energi": ["larangan ekspor", "opec", "harga acuan batu bara"],
    "Risiko global": ["perang dagang", "resesi", "krisis keuangan", "devaluasi", "sanksi ekonomi", "gagal bayar utang"],
}
MEDIUM_PHRASES = {
    "Aksi korporasi": [
        "emiten", "ipo", "rights issue", "right issue", "dividen", "laba bersih", "rugi bersih", "akuisisi", "merger", "buyback", "obligasi korporasi",
        "gagal bayar", "pailit", "pkpu", "delisting",
    ],
    "Pasar & nilai tukar": [
        "ihsg", "rupiah", "nilai tukar", "kurs", "yield sbn", "surat berharga negara", "obligasi negara", "modal asing", "suku bunga", "bank indonesia",
        "harga minyak", "harga emas", "harga batu bara", "harga nikel", "harga cpo",
    ],
    "Sektor & industri": [
        "phk", "pemutusan hubungan kerja", "kredit macet", "npl", "likuiditas", "investasi asing", "penanaman modal", "ekspor", "impor", "manufaktur",
        "properti", "otomotif", "perbankan", "kapasitas produksi", "upah minimum", "ump", "hilirisasi", "pertumbuhan ekonomi", "daya beli", "pdb",
    ],
    "Regulasi": [
        "ruu", "peraturan menteri", "perpres", "perppu", "inpres", "regulasi", "moratorium", "relaksasi", "kuota impor", "pajak", "cukai", "subsidi",
        "izin usaha", "insentif pajak",
    ],
}
DISCARD_PHRASES = [
    "resmikan", "diresmikan", "peresmian", "groundbreaking", "seremoni", "hut ke", "ulang tahun", "santunan", "bakti sosial", "promo", "diskon", "giveaway",
    "undian berhadiah", "lomba", "juara", "pertandingan", "liga", "piala", "timnas", "klasemen", "prediksi skor", "artis", "selebriti", "sinetron", "drakor",
    "konser", "tips", "cara mudah", "cara cek", "resep", "wisata", "kuliner", "zodiak", "horoskop", "ramalan", "link download", "jadwal sholat", "begal",
    "pencurian", "pembunuhan", "pemerkosaan", "pelecehan", "narkoba", "sabu", "curanmor", "penganiayaan", "tawuran",
]
ACCIDENT_PHRASES = ["kecelakaan", "tabrakan", "laka lantas"]
DISASTER_EVENTS = [
    "kapal", "kmp", "feri", "ferry", "perahu", "speedboat", "tongkang", "tenggelam", "terbalik", "karam", "kandas", "pesawat", "helikopter", "kereta", "krl",
    "lrt", "bus", "truk", "kecelakaan", "tabrakan", "terguling",
]
DISASTER_SCALE = ["penumpang", "awak", "nakhoda", "kru", "hilang", "evakuasi", "dievakuasi", "basarnas", "sar", "pencarian", "puluhan", "ratusan", "massal"]

# -- fixed values: direction
TITLE_WEIGHT, SUMMARY_WEIGHT, LEFT_REACH, RIGHT_REACH, NEGATION_REACH = 2, 1, 4, 2, 2
NEGATIONS = ["tidak", "tak", "bukan", "belum", "batal", "urung", "tanpa", "menolak", "tolak", "mencegah", "cegah", "not"]
REVERSERS = ["hambat", "hambatan", "menghambat", "terhambat", "penghambat", "penghalang", "kendala", "gagal", "anjlokkan"]
UP_WORDS = [
    "naik", "menaik", "menaikkan", "kenaikan", "meningkat", "meningkatkan", "peningkatan", "melonjak", "lonjakan", "meroket", "menguat", "penguatan", "tumbuh",
    "pertumbuhan", "melesat", "bertambah", "menambah", "menambahkan", "melambung", "rebound", "reli", "rally", "tertinggi", "puncak", "memuncak",
]
DOWN_WORDS = [
    "turun", "menurun", "menurunkan", "penurunan", "anjlok", "merosot", "melemah", "melemahkan", "pelemahan", "ambles", "ambruk", "jeblok", "terkoreksi",
    "koreksi", "menyusut", "susut", "tergerus", "berkurang", "mengurangi", "memangkas", "pangkas", "pemangkasan", "memotong", "longsor", "lesu", "loyo",
    "terendah", "melambat", "perlambatan",
]
GOOD_SUBJECTS = [
    "laba", "untung", "keuntungan", "pendapatan", "penjualan", "omzet", "dividen", "ekspor", "investasi", "modal", "produksi", "kapasitas", "ekonomi", "pdb",
    "konsumsi", "cadangan", "devisa", "surplus", "ihsg", "indeks", "saham", "rupiah", "kurs", "obligasi", "sbn", "kredit", "pembiayaan", "likuiditas", "upah",
    "gaji", "ump", "umk", "daya", "lapangan", "wisatawan", "kunjungan", "panen", "pasokan", "produktivitas", "manufaktur", "pmi", "emas", "bara", "nikel",
    "cpo", "sawit", "minyak", "komoditas", "harga", "keyakinan", "kepercayaan", "konsumen", "permintaan", "optimisme", "realisasi", "laju",
]
BAD_SUBJECTS = [
    "inflasi", "utang", "defisit", "rugi", "kerugian", "pengangguran", "phk", "kemiskinan", "npl", "macet", "biaya", "beban", "ongkos", "cukai", "pajak",
    "tarif", "pungutan", "iuran", "impor", "korupsi", "risiko", "ketidakpastian", "tekanan", "volatilitas", "bunga", "suku", "yield", "premi", "denda",
    "sanksi", "bencana", "banjir", "kebakaran", "karhutla", "gempa", "wabah", "polusi", "kecelakaan", "konflik", "perang", "protes", "demo", "mogok",
]
POSITIVE_PHRASES = [
    "rekor tertinggi", "level tertinggi", "all time high", "cetak rekor", "kesepakatan dagang", "kerja sama", "kerjasama", "kesepakatan", "insentif",
    "keringanan pajak", "relaksasi", "stimulus", "pelonggaran", "pelonggaran moneter", "bantuan", "hibah", "pemulihan", "membaik", "perbaikan", "optimisme",
    "optimistis", "pulih", "ekspansi", "peluang", "terobosan", "ipo", "right issue", "rights issue", "buyback", "bagi dividen", "tebar dividen",
    "melampaui target", "di atas ekspektasi", "lebih baik dari perkiraan", "peringkat naik", "arus masuk", "net buy", "capital inflow", "penurunan suku bunga",
    "pangkas suku bunga", "pemangkasan suku bunga", "bebas bea", "penghapusan tarif", "hilirisasi",
]
NEGATIVE_PHRASES = [
    "gagal bayar", "default", "pailit", "bangkrut", "pkpu", "delisting", "suspensi saham", "resesi", "krisis", "krisis keuangan", "devaluasi",
    "sanksi ekonomi", "embargo", "perang dagang", "perang tarif", "larangan ekspor", "larangan impor", "moratorium", "pembatasan", "kuota impor", "bea masuk",
    "tarif impor", "kenaikan cukai", "kenaikan tarif", "ppn naik", "pemutusan hubungan kerja", "phk massal", "rumahkan karyawan", "tutup pabrik",
    "hentikan operasi", "setop produksi", "kredit macet", "kredit bermasalah", "lilitan utang", "di bawah ekspektasi", "meleset dari target", "gagal memenuhi",
    "downgrade", "peringkat turun", "arus keluar", "net sell", "capital outflow", "aksi jual", "panic selling", "kenaikan suku bunga", "pengetatan moneter",
    "gejolak", "ketidakpastian", "kekhawatiran", "khawatir", "mengkhawatirkan", "tertekan", "memanas", "eskalasi", "terancam", "ancaman", "waswas", "hambat",
    "hambatan", "menghambat", "terhambat", "penghambat", "penghalang", "kendala", "korupsi", "penyelewengan", "penggelapan", "tersangka", "gugatan", "denda",
    "kelangkaan", "gagal panen", "pemadaman", "mogok kerja", "unjuk rasa", "kerusuhan", "penipuan",
]

# -- fixed values: tax
TAX_MOVES_FROM = ["makro", "politik"]
TAX_MARKERS = [
    "pajak", "perpajakan", "ditjen pajak", "djp", "coretax", "fiskus", "pph", "ppnbm", "npwp", "spt", "wajib pajak", "tax amnesty", "tax holiday",
    "tax allowance", "tax ratio", "bea cukai", "cukai", "kepabeanan", "bea masuk", "bea keluar", "pmse", "spp tdln", "pbb p2", "pbjt", "bbnkb", "opsen",
    "rokok ilegal",
]
TAX_FOREIGN = ["vietnam.vn"]
TAX_AMBIGUOUS = {
    "restitusi": ["korban", "pelaku", "lpsk", "terdakwa", "vonis", "dibui", "penjara", "pidana penjara"],
    "ppn": ["pelabuhan", "perikanan", "nelayan", "rumpon", "sdkp"],
}
TAX_REGIONAL = [
    "pajak daerah", "pajak kendaraan", "bbnkb", "samsat", "opsen", "pbb p2", "pajak pbb", "pajak bumi dan bangunan", "pajak reklame", "pajak hotel",
    "pajak restoran", "pajak hiburan", "pbjt", "pajak air tanah", "retribusi", "bapenda", "bpkad", "pendapatan asli daerah", "pad", "pemutihan", "pemkab",
    "pemkot", "pemprov", "bupati", "wali kota", "walikota", "gubernur", "dprd", "dprk", "sekda", "fiskal daerah", "kas daerah",
]
REGIONAL_DOMAINS = ["prov.go.id", "kab.go.id", "kota.go.id"]
TAX_DISCARD = [
    "brevet", "early bird", "webinar", "seminar", "segera daftar", "gabung sekarang", "belajar di sini", "unduh di sini", "kelas pajak", "pelatihan",
    "pajak bertutur", "bincang pajak", "gebyar", "kompetisi", "pemenang", "penghargaan", "edukasi", "cara lapor", "cara mengajukan", "cara menghitung",
    "cara bayar", "cara daftar", "cara membuat", "begini cara", "simak cara", "artikel dan berita",
]
TAX_TOPICS = {
    "Penegakan hukum": [
        "kpk", "gratifikasi", "suap", "korupsi", "pidana pajak", "penyidikan", "tersangka", "penyitaan", "sita", "gijzeling", "perampasan aset", "dirampas",
        "penagihan", "tunggakan", "rokok ilegal", "penyelundupan",
    ],
    "Restitusi": ["restitusi", "pengembalian pendahuluan"],
    "Coretax & layanan": ["coretax", "downtime", "waktu henti", "djp online", "e faktur", "efaktur", "e bupot", "aplikasi", "layanan"],
    "Pajak digital & internasional": [
        "pmse", "transaksi digital", "platform digital", "kripto", "spp tdln", "pajak minimum global", "global minimum tax", "pilar dua", "p3b", "tax treaty",
        "oecd", "lintas negara", "luar negeri",
    ],
    "Kepabeanan & cukai": ["bea cukai", "cukai", "bea masuk", "bea keluar", "kepabeanan"],
    "Profesi & sengketa": ["konsultan pajak", "kuasa wajib pajak", "pengadilan pajak", "sengketa pajak", "banding", "keberatan", "ikpi"],
    "Penerimaan & target": [
        "penerimaan pajak", "penerimaan negara", "penerimaan perpajakan", "target penerimaan", "shortfall", "tax ratio", "rasio pajak", "realisasi",
        "basis pajak", "potensi pajak", "ekstensifikasi",
    ],
    "Tarif & insentif": ["tarif", "insentif", "tax holiday", "tax allowance", "dtp", "ditanggung pemerintah", "pembebasan", "fasilitas", "diskon pajak"],
    "Aturan baru": [
        "pmk", "peraturan menteri keuangan", "pp", "peraturan pemerintah", "perdirjen", "peraturan dirjen", "surat edaran", "ruu", "uu", "aturan baru", "sop",
    ],
}
TAX_REGIONAL_TOPIC = "Pajak daerah"

# -- fixed values: AI
AI_MOVES_FROM = ["makro", "politik", "global"]
AI_CAPITALS = r"(?<![A-Za-z])A\.?I\.?(?![A-Za-z])"
AI_MARKERS = [
    "kecerdasan buatan", "kecerdasan artifisial", "artificial intelligence", "generative ai", "genai", "chatgpt", "gpt", "openai", "anthropic", "deepseek",
    "google gemini", "copilot", "grok", "xai", "llm", "llms", "large language model", "machine learning", "deep learning", "chatbot", "superintelligence",
    "humanoid", "nvidia", "sam altman", "jensen huang", "dario amodei", "demis hassabis",
]
AI_AMBIGUOUS = {"claude": ["anthropic", "ai", "chatbot", "model"], "gemini": ["google", "ai", "chatbot", "model"], "llama": ["meta", "ai", "model"]}
AI_DISCARD = [
    "prompt", "tren foto", "foto jadul", "edit foto", "cara membuat", "cara pakai", "cara menggunakan", "cara bikin", "begini cara", "simak cara", "trik",
    "tutorial", "tips", "rekomendasi", "sosialisasi", "seminar", "webinar", "workshop", "pelatihan", "konferensi", "expo", "pameran", "lomba", "kompetisi",
    "melek", "bijak", "imbau", "polres", "polsek", "kapolres", "diskominfo", "spesifikasi", "berapa harganya", "laptop", "tablet", "smartwatch", "opini",
    "opinion", "kolom",
]
AI_DISCARD_DOMAINS = [
    "kompasiana.com", "vietnam.vn", "britannica.com", "einnews.com", "einpresswire.com", "prnewswire.com", "globenewswire.com", "businesswire.com",
    "nvidia.com",
]
AI_DISCARD_ENDS = ["prov.go.id", "kab.go.id", "kota.go.id", "polri.go.id", ".ac.id", ".sch.id"]
AI_TOPICS = {
    "Regulasi & hukum": [
        "regulasi", "aturan", "perpres", "uu", "ruu", "undang undang", "hak cipta", "gugatan", "digugat", "pengadilan", "komdigi", "regulation", "regulators",
        "law", "lawsuit", "sued", "court", "copyright", "congress", "senate", "white house", "gedung putih", "ai act", "ban", "larang",
    ],
    "Keamanan & risiko": [
        "keamanan", "risiko", "bahaya", "ancaman", "musnahkan", "kepunahan", "senjata", "penyalahgunaan", "deepfake", "hoaks", "siber", "kebocoran", "safety",
        "risk", "risks", "threat", "extinction", "bioweapon", "bioweapons", "weapons", "misuse", "cyber", "espionage", "distillation", "distilasi", "tiru",
        "kill", "doom",
    ],
    "Chip & infrastruktur": [
        "nvidia", "chip", "chips", "gpu", "gpus", "semikonduktor", "semiconductor", "tsmc", "data center", "data centers", "data centre", "pusat data",
        "infrastruktur", "infrastructure", "komputasi", "compute",
    ],
    "Pendanaan & bisnis": [
        "pendanaan", "valuasi", "investasi", "akuisisi", "merger", "ipo", "rights issue", "saham", "laba", "pendapatan", "kerja sama", "funding", "raises",
        "valuation", "invest", "investment", "acquire", "acquisition", "stock", "shares", "earnings", "revenue", "deal",
    ],
    "Model & produk": [
        "model", "rilis", "luncurkan", "meluncurkan", "fitur", "aplikasi", "agen ai", "agentic", "launch", "launches", "release", "releases", "unveils",
        "introducing", "agent", "agents", "app", "gpt", "chatgpt", "claude", "gemini",
    ],
    "Kerja & adopsi": ["pekerjaan", "karyawan", "phk", "tenaga kerja", "adopsi", "umkm", "pendidikan", "belajar", "jobs", "workers", "layoffs", "adoption"],
}
LABELS = {"wide": "Liputan luas", "wider": "Liputan meluas", "primary": "Sumber primer", "disaster": "Kecelakaan transportasi"}
