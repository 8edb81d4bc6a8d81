"""Problem 3: template residue and error-page text.

Character n-gram models are fitted for template syntax (placeholders, technical values), for filler, for error and script notices, and
for natural prose. The first three and a small model of how people write about such things are fitted to example phrases, a parameter;
the prose model is counted over the whole corpus, leaving out lines the others already explain, and n-grams too rare in it count as
unseen, so residue in the corpus doesn't pass for prose. Residue is localised by windows of the log-likelihood ratio (the maximal
segments of its running sum, within lines); a window counts unless its sentence writes about or quotes such a thing. A record is
excluded by the share of its characters that its windows cover; at the default of 0 one window is enough.

The corpus counts are tables of fixed size, summed by streams; both passes read texts once and shuffle nothing of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from lontar.session import cut

U64 = np.uint64
#: Slots of the tables of 5-, 4-, 3- and 2-gram counts, as powers of two.
SLOTS = (19, 19, 17, 16)
SEED_SLOTS = (17, 17, 16, 16)
CHUNK = 1 << 15

_NAMES = ["nama", "judul", "title", "headline", "author", "penulis", "kutipan", "caption", "article.title", "article.lead", "foto_utama", "ringkasan", "tanggal", "isi", "lead", "kategori", "content", "name", "lokasi", "sumber"]
_ASKS = ["nama kota", "masukkan angka", "nama narasumber", "judul", "isi di sini", "tanggal", "nama penulis", "insert name", "your text here", "masukkan judul", "sebutkan sumber"]
_LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
_FILL = "isi teks contoh judul paragraf tulisan konten sampel dummy sementara bagian blok uji coba nanti akan ini diganti".split()


def _template_seeds() -> list[str]:
    out = []
    for n in _NAMES:
        up = n.upper()
        marks = [f"{{{{ {n} }}}}", f"{{{{{n}}}}}", f"${{{n}}}", f"<%= {n} %>", f"{{{n}}}", f"%{up}%", f"%%{n}%%", f"@@{up}@@", f":{n}:", f"${n}$", f"{{% include '{n}' %}}", f"[[{n}-0]]", f"__{n}__", f"<{n}>", f"[{up}]"]
        out += [f"kata {m} dan" for m in marks] + marks
    for a in _ASKS:
        out += [f"di [{a}] pada", f"oleh <{a}> di", f"[{a.upper()}]", f"dan [{a}]."]
    for i in ("0", "00"):
        out += [f"di {{{i}}} dan", f"[[gambar-{i}]] dan", f"di <!-- slot iklan {i} --> dan", f"<!-- slot iklan {i} -->", f"artikel baru ({i})", i]
    for v in ("undefined", "null null", "null", "\x02", "[object object]", "#value!", "#ref!", "#n/a", "none none", "(null)"):
        out += [f"yang {v} di", f"di {v}.", f"dan {v} dan", f"{v} selain"] + ([v] if len(v) > 3 else [])
    for c in "abcdefghijklmnopqrstuvwxyz,.":  # after and before any letter
        out += [f"{c} {m} {c}" for m in ("\x02", "{0}", "{00}") for _ in range(3)] + [f"\x02 {c}"] + [f"{c} {m} {c}" for m in ("undefined", "null null", "[object object]", "#value!", "%judul%")]
    out += ["{0}", "\x02", "undefined - warta", "%title% - warta", "warta :: null", "warta - undefined", "null - kabar", "di xxxx dan", "pada xxxx.", "xxxx", "xxxxx", "tbd: isi", "(isi paragraf di sini)", "(isi di sini)", "(tulis di sini)", "(nama di sini)"]
    return out


def _filler_seeds() -> list[str]:
    out = ["untitled document", "untitled", "draf tanpa judul", "judul berita di sini", "judul artikel di sini", "tulis judul di sini", "judul maksimal 00 karakter", "article title", "your headline here", "isi berita di sini", "test test", "asdf asdf", "qwerty"]
    rng = np.random.default_rng(5)
    for words in (_LATIN, _FILL):
        for _ in range(80):
            w = [words[i] for i in rng.integers(0, len(words), 8)]
            out += [" ".join(w) + ".", " ".join(w[:3]) + " 0a0b0c"]
    return out


def _key_seeds() -> list[str]:
    rng = np.random.default_rng(6)
    keys = list("asdfghjklasdfghjklqwertyuiop")
    return [" ".join("".join(keys[i] for i in rng.integers(0, len(keys), k)) for k in rng.integers(3, 9, 8)) + "." for _ in range(400)]


#: Examples of placeholders that were never filled and of technical values in a text's stead.
TEMPLATE = _template_seeds()
#: Examples of filler: blind text and stand-in titles.
FILLER = _filler_seeds()
#: Examples of keys struck at random.
KEYS = _key_seeds()
# Reason phrases of HTTP.
_REASONS = {400: "bad request", 401: "unauthorized", 403: "forbidden", 404: "not found", 408: "request timeout", 410: "gone", 429: "too many requests", 500: "internal server error", 502: "bad gateway", 503: "service unavailable", 504: "gateway timeout"}


def _notice_seeds() -> list[str]:
    """Titles and sentences of error, block and maintenance pages and of script notices, from what pages of that kind say: what is
    missing or wrong, what the reader is asked to do, and which technical reference follows."""
    out = [x for k, v in _REASONS.items() for x in (v, v, f"{k} {v}", f"{k} {v}", f"error {k} {v}", f"error {k}", f"{k}: {v}", f"galat {k}", f"kesalahan {k}", f"http error {k} - {v}")]
    what = ["halaman", "artikel", "berita", "alamat", "konten", "berkas", "dokumen"]
    out += [f"{a} {b}" for a in what for b in ("tidak ditemukan", "tidak tersedia", "sudah dipindahkan", "sudah dihapus", "tidak dapat ditampilkan", "tidak dapat dimuat", "tidak dapat dibuka", "yang anda cari tidak ditemukan", "ini tidak tersedia di negara anda", "ini tidak tersedia di wilayah anda", "ini hanya tersedia di wilayah tertentu")]
    out += [f"anda tidak {a} {b} untuk {v} {x}" for a, b in (("memiliki", "izin"), ("punya", "hak"), ("memiliki", "hak akses"), ("diberi", "izin")) for v in ("membuka", "melihat", "mengakses", "membaca") for x in ("halaman ini", "artikel ini", "/news/00000000/00", "/artikel/00000000")]
    out += [f"{a} {b}" for a in ("this page", "this site", "this article", "the content") for b in ("works only with scripts on", "works only with javascript switched on", "needs scripting to be on", "requires scripting", "is loaded by scripts, which are switched off", "cannot be shown without javascript")]
    site = ["situs", "laman", "layanan", "server", "peladen", "sistem", "aplikasi", "basis data"]
    out += [f"{a} {b}" for a in site for b in ("sedang dalam pemeliharaan", "sedang diperbaiki", "dalam perbaikan rutin", "tidak dapat dihubungi", "sedang sibuk", "sedang tidak tersedia", "mengalami gangguan", "kami sedang kami perbarui")]
    doing = ["aktifkan", "nyalakan", "hidupkan", "izinkan", "matikan", "nonaktifkan", "mohon aktifkan", "silakan aktifkan", "harap nyalakan"]
    things = ["javascript", "skrip", "kuki", "cookie", "javascript dan kuki", "pemblokir iklan", "mode penyamaran"]
    ends = ["pada peramban anda", "di browser anda", "untuk membuka halaman ini", "untuk melanjutkan", "untuk membaca artikel ini", "lalu muat ulang halaman", "terlebih dahulu", "agar situs ini berfungsi"]
    out += [f"{d} {t} {e}" for i, d in enumerate(doing) for j, t in enumerate(things) for e in (ends[(i + j) % len(ends)], ends[(i + 3 * j + 1) % len(ends)])]
    out += [f"{a} {t} {b}" for t in ("javascript", "skrip", "kuki", "cookie") for a, b in (("situs ini memerlukan", "agar dapat berjalan"), ("situs ini membutuhkan", "untuk berfungsi"), ("peramban anda tidak mendukung", "atau fitur itu dimatikan"), ("isi halaman dimuat dengan", "yang harus dinyalakan"))]
    out += [
        "terjadi kesalahan pada server", "maaf, terjadi kesalahan", "silakan coba beberapa saat lagi", "silakan coba lagi nanti", "kami akan segera kembali", "mohon tunggu sebentar", "waktu koneksi habis", "waktu tunggu habis saat menghubungi server", "sambungan ke basis data gagal",
        "sesi anda telah berakhir", "sesi berakhir, silakan masuk kembali", "silakan masuk kembali untuk melanjutkan", "anda tidak memiliki izin untuk mengakses halaman ini", "anda tidak memiliki hak akses", "akses ditolak", "akses anda diblokir", "permintaan terlalu banyak dari alamat anda", "terlalu banyak permintaan dari jaringan anda",
        "buktikan bahwa anda bukan robot", "selesaikan captcha berikut", "selesaikan tantangan untuk melanjutkan", "kami sedang memeriksa peramban anda", "proses ini otomatis", "kode rujukan: 0a0b0c", "kode galat 0a0b", "id permintaan: 0a0b", "nomor tiket 0a0b",
        "page not found", "this page could not be found", "the page you requested was not found", "the requested resource was not found on this server", "the requested url was not found on this server", "it may have been moved or deleted", "under maintenance", "we are performing scheduled maintenance", "we will be back soon", "please try again later", "please come back in a few minutes",
        "something went wrong", "oops! something went wrong", "an unexpected error occurred", "access denied", "you do not have permission to view this page", "your access has been blocked", "your session has expired", "please log in again", "this content is not available in your region", "this content is not available in your country",
        "just a moment", "just a moment...", "one moment, please", "attention required", "attention required!", "checking your browser before accessing the site", "this process is automatic", "verify that you are human", "please complete the captcha", "prove you are not a robot", "unusual traffic from your network", "too many requests from your network", "ray id: 0a0b0c", "request id: 0a0b0c", "reference #0a0b",
        "you need to enable javascript to run this app", "please enable javascript", "please enable javascript and cookies to continue", "please turn on javascript and reload the page", "javascript is disabled in your browser", "this site requires javascript", "this page requires scripts to be switched on", "scripts are turned off", "please enable cookies", "please disable your ad blocker", "turn off your ad blocker to continue reading", "your browser is not supported",
        "fatal error", "uncaught typeerror: cannot read properties of undefined", "cannot read property of null", "cannot read property of undefined", "exception in thread main", "stack trace", "traceback (most recent call last)", "warning: undefined variable", "warning: mysqli_connect(): connection refused", "connection timed out", "connection to the database failed", "sql error", "trace id 0a0b", "proxy error", "noscript", "nginx", "cloudflare",
    ]
    return out


#: Examples of error, block and maintenance pages and of notices asking for scripts and the like.
NOTICES = _notice_seeds()
_THINGS = ["istilah", "kata", "tulisan", "pesan", "tanda", "kode", "kolom", "contoh", "peringatan", "galat", "teks", "judul", "the word", "the words", "the term", "the message", "the error", "the text", "the placeholder", "the column", "the warning", "the title"]
_DONE = ["dibahas", "muncul", "tampil", "berbunyi", "ditulis", "dijelaskan", "berarti", "tertulis", "disebut", "dipakai", "terbaca", "appears", "appeared", "is shown", "was shown", "means", "reads", "is explained", "is called", "was written", "kept popping up"]
_SAID = ["menulis", "menampilkan", "memuat", "menjelaskan", "menceritakan", "membaca", "melihat", "membahas", "menyebut", "menerima", "mencari", "menandai", "berisi", "bernama", "shows", "showed", "wrote", "explains", "explained", "recalled", "saw", "reads", "discusses", "quotes", "looking for", "contains"]
_WHERE = ["pada halaman", "di layar", "dalam buku panduan", "di kelas", "dalam pelatihan", "pada formulir", "dalam program", "saat mendaftar", "di peramban", "dalam surel", "on page", "on the screen", "in the manual", "in class", "in a training course", "on the form", "in the program", "when registering", "in the browser", "in an email"]
_ASKED = ["mengapa muncul", "apa arti", "arti kode", "bagaimana cara kerja", "begitu bunyi", "cara kerja", "selama 00 menit", "00 kali", "why does", "what is the meaning of", "how does", "for 00 minutes", "00 times", "kisah", "catatan tentang", "the story of", "a note on"]


def _mention_seeds() -> list[str]:
    """What is said around such things, from what is spoken of, what is said of it, by whom and where."""
    out = [*_WHERE, *_ASKED]
    for x in _THINGS:
        out += [f"{v} {x}" for v in _SAID if x.startswith("the ") == v.isascii() and (x.startswith("the ") == (v in _SAID[14:]))]
        out += [f"{x} {v}" for v in _DONE if x.startswith("the ") == (v in _DONE[11:])]
    return out


#: Phrases around such things when a text writes about or quotes them.
MENTIONS = _mention_seeds()


_NAN = re.compile(r"\bNaN\b")


def encode(s: str) -> np.ndarray:
    """Lines as small codes: lower case, digits alike."""
    if "NaN" in s:
        s = _NAN.sub("\x02", s)
    cp = np.frombuffer(s.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((cp >= 48) & (cp <= 57), 48, np.where(cp < 128, cp, 128 + (cp * 2654435761 >> 8) % 128)).astype(np.uint8)


def lines_of(title: str | None, text: str | None, most: int = 1_000_000) -> Iterator[str]:
    """Title and text with a line feed before, between and after, in pieces of whole lines; nothing that is counted or judged crosses lines."""
    s = f"\n{title or ''}\n{text or ''}\n"
    at = 0
    while len(s) - at > most:
        stop = s.rfind("\n", at, at + most) + 1
        if stop <= at + 1:
            stop = s.find("\n", at + 1) + 1 or len(s)
        yield s[at:stop]
        at = stop
    if at < len(s):
        yield s[at:]


def _slots(c: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Slots of the 5-, 4- (context), 3- and 2-grams that end at each code; contexts end one code before."""
    x = c.astype(U64)
    lf = U64(10)
    b1, b2, b3, b4 = (np.r_[np.full(min(k, len(x)), lf), x[: max(0, len(x) - k)]] for k in (1, 2, 3, 4))
    # nothing before a line's begin matters
    b2 = np.where(b1 == lf, lf, b2)
    b3 = np.where(b2 == lf, lf, b3)
    b4 = np.where(b3 == lf, lf, b4)
    two = b1 | b2 << U64(8)
    four = two | b3 << U64(16) | b4 << U64(24)
    five, three = x | four << U64(8), x | two << U64(8)
    mul = U64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        return [((v * mul) >> U64(64 - s)).astype(np.int64) for v, s in zip((five, four, three, two), sizes)]


@dataclass
class Model:
    """Interpolated 5-gram model over hashed counts."""

    tables: list[np.ndarray]
    sizes: tuple[int, ...]
    keep: float = 1.0

    def log(self, slots: list[np.ndarray]) -> np.ndarray:
        c5, c4, c3, c2 = (t[s] for t, s in zip(self.tables, slots))
        p3 = (c3 + self.keep / 80) / (c2 + self.keep)
        return np.log((c5 + self.keep * p3) / (c4 + self.keep))


    def ratio(self, slots: list[np.ndarray], other: np.ndarray, order: int = 3) -> np.ndarray:
        """Log-likelihood ratio to another model's logs, clipped; only n-grams that this model has seen speak for it."""
        seen = (self.tables[2][slots[2]] if order == 3 else self.tables[0][slots[0]]) > 0
        r = np.clip(self.log(slots) - other, -4.0, 6.0)
        return np.where(seen, r, np.minimum(r, -1.0)).astype(np.float64)


def fit_seeds(phrases: list[str]) -> Model:
    """A model of example phrases, each a line of its own and within a line."""
    tables = [np.zeros(1 << s, np.float32) for s in SEED_SLOTS]
    for p in phrases:
        for s in (f"\n{p}\n", f" {p} "):
            cp = np.frombuffer(s.lower().encode("utf-32-le"), np.uint32)
            c = np.where((cp >= 48) & (cp <= 57), 48, np.minimum(cp, 255)).astype(np.uint8)
            for t, at in zip(tables, _slots(c, SEED_SLOTS)):
                np.add.at(t, at[1:], 1)
    return Model(tables, SEED_SLOTS, 0.5)


@dataclass
class Phrases:
    """What the seeded models are fitted to."""

    template: tuple[str, ...] = tuple(TEMPLATE)
    filler: tuple[str, ...] = tuple(FILLER)
    keys: tuple[str, ...] = tuple(KEYS)
    notices: tuple[str, ...] = tuple(NOTICES)
    mentions: tuple[str, ...] = tuple(MENTIONS)


@dataclass
class Seeded:
    """The models of the phrases, fitted by the driver; their size is fixed."""

    template: Model
    filler: Model
    keys: Model
    notices: Model
    mentions: Model


def seeded(phrases: Phrases) -> Seeded:
    return Seeded(*(fit_seeds(list(x)) for x in (phrases.template, phrases.filler, phrases.keys, phrases.notices, phrases.mentions)))


@dataclass
class Prose:
    """Counts of natural prose, and two models of them: n-grams under a share of the records count as unseen. Words of template syntax
    recur as placeholders, so they are held against the stricter one."""

    strict: Model
    loose: Model


def _streams(titles: list, texts: list, most: int = 1_000_000) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Blocks of records as one stream of codes: the number of the record of each piece, the codes, where each piece begins."""
    owners, parts, size = [], [], 0
    for i, (title, text) in enumerate(zip(titles, texts)):
        for piece in lines_of(title, text, most):
            owners.append(i)
            parts.append(encode(piece))
            size += len(parts[-1])
            if size >= most:
                yield owners, np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])
                owners, parts, size = [], [], 0
    if parts:
        yield owners, np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])


def count_prose(rows: DataFrame, shared: Broadcast, rare: tuple[float, float]) -> Prose:
    """The prose models: n-grams of all titles and texts but lines that the seeded models explain, less shares ``rare`` of the records, but one at least."""
    sizes = [1 << s for s in SLOTS]
    edges = np.cumsum([0, *sizes])

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = [shared.value.filler, shared.value.notices, shared.value.keys]
        total = np.zeros(edges[-1], np.int64)
        records = 0
        for b in batches:
            records += len(b)
            for _, c, _ in _streams(b["title"].tolist(), b["text"].tolist()):
                line = np.cumsum(c == 10)
                seed_slots = _slots(c, SEED_SLOTS)
                n = np.bincount(line)
                explained = np.zeros(len(n), bool)
                for m, least, start in zip(models, (-1.0, -1.0, -3.3), (12, 8, 0)):  # how a line begins is free
                    explained |= np.bincount(line, weights=m.log(seed_slots)) > least * np.maximum(1, n) - start
                use = ~explained[line]
                for t, at in zip(range(4), _slots(c, SLOTS)):
                    total[edges[t] : edges[t + 1]] += np.bincount(at[use], minlength=sizes[t])
        for k in range(0, len(total), CHUNK):
            yield pd.DataFrame({"chunk": [k // CHUNK], "data": [total[k : k + CHUNK].tobytes()], "records": [records if k == 0 else 0]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for b in batches:
            for k, d, r in zip(b["chunk"], b["data"], b["records"]):
                have = held.setdefault(int(k), [np.zeros(len(d) // 8, np.int64), 0])
                have[0] = have[0] + np.frombuffer(d, np.int64)
                have[1] += int(r)
        for k, (d, r) in held.items():
            yield pd.DataFrame({"chunk": [k], "data": [d.tobytes()], "records": [r]})

    kind = "chunk int, data binary, records long"
    chunks = int(-(-edges[-1] // CHUNK))
    # a table for each task, not for each split of a large corpus
    few = rows.coalesce(4 * rows.sparkSession.sparkContext.defaultParallelism)
    summed = few.mapInPandas(local, kind).repartitionById(chunks, F.col("chunk")).mapInPandas(add, kind).toPandas()
    whole = np.zeros(int(chunks) * CHUNK, np.float32)
    for k, d in zip(summed["chunk"], summed["data"]):
        part = np.frombuffer(d, np.int64)
        whole[k * CHUNK : k * CHUNK + len(part)] = part
    records = float(summed["records"].sum())
    whole_tables = [whole[edges[t] : edges[t + 1]] for t in range(4)]
    return Prose(*(Model([np.maximum(0, x - max(1.0, r * records)) for x in whole_tables], SLOTS, max(1.0, r * records)) for r in rare))


def _peaks(ratio: np.ndarray, line_end: np.ndarray) -> np.ndarray:
    """The running sum of the ratio that starts anew wherever it falls below zero, and at each line's end."""
    r = ratio.astype(np.float64)
    starts = np.flatnonzero(line_end) + 1
    starts = starts[starts < len(r)]
    r[starts] -= 1e4
    total = np.cumsum(r)
    return total - np.minimum.accumulate(np.minimum(total, 0))


#: Signs of template syntax and words of technical values; a window of the template kind holds one.
_SIGNS = re.compile(rb"[{}$%<>\[\]@#|_\x02]|undefined|null|none|xxx|todo|tbd|:\w+:|\((isi|tulis|nama) |\(0{1,3}(?![0/])|^\n?0+\n?$")


#: The part of the likelihood ratio that is enough for a whole line.
WHOLE_LINE = 0.75


def windows(c: np.ndarray, prose: Prose, seeds: Seeded, least: tuple[float, float, float]) -> list[tuple[int, int, int]]:
    """(kind, from, to) of residue windows in a stream of codes: kind 0 template, 1 filler, 2 notice."""
    seed_slots, slots = _slots(c, SEED_SLOTS), _slots(c, SLOTS)
    strict, loose = prose.strict.log(slots), prose.loose.log(slots)
    out = []
    for kind, model, p, order, need in ((0, seeds.template, strict, 3, least[0]), (1, seeds.filler, loose, 5, least[1]), (1, seeds.keys, loose, 3, 2 * least[1]), (2, seeds.notices, loose, 3, least[2])):
        s = _peaks(model.ratio(seed_slots, p, order), c == 10)
        over = s >= need
        if kind == 2:  # a line that is a notice from its begin to its end needs less
            feeds = np.flatnonzero(c == 10)
            rose = np.maximum.accumulate(np.where(s <= 0, np.arange(len(s)), -1))
            ends = feeds[1:] - 1
            over[ends[(s[ends] >= WHOLE_LINE * need) & (rose[ends] <= feeds[:-1] + 1)]] = True
        edge = np.flatnonzero(np.diff(np.r_[False, over, False].astype(np.int8)))
        for lo, hi in zip(edge[::2], edge[1::2]):
            zero = np.flatnonzero(s[max(0, lo - 400) : lo] <= 0)
            start, stop = max(0, lo - 400) + int(zero[-1]) + 1 if len(zero) else lo, lo + int(s[lo:hi].argmax()) + 1
            if kind or _SIGNS.search(c[max(0, start - 2) : stop + 1].tobytes()):
                out.append((kind, start, stop))
    return out


def _sentence(c: np.ndarray, lo: int, hi: int) -> tuple[int, int]:
    """The sentence around a window: between line feeds and end marks that a space follows."""
    while lo > 0 and c[lo - 1] != 10 and not (c[lo - 1] == 32 and lo > 1 and c[lo - 2] in b".!?" and not (lo > 3 and c[lo - 4] == 32)):
        lo -= 1
    while hi < len(c) and c[hi] != 10 and not (c[hi] == 32 and c[hi - 1] in b".!?" and not (hi > 2 and c[hi - 3] == 32)):
        hi += 1
    return lo, hi


#: A noun of language right before a window (which may begin within a word), and a demonstrative about its end.
_NAMED = re.compile((r"\b(" + "|".join(_THINGS) + r")( (yang|berupa|called))? ?[\"'(]?\w{0,3}$").encode())
_POINTED = re.compile(rb"^[^.!?\n]{0,8}?(^| |\")(itu|ini|tersebut|tadi|there|itself)\b")


def is_mention(c: np.ndarray, kind: int, lo: int, hi: int, prose: Prose, seeds: Seeded, least: float) -> bool:
    """Whether the sentence around a window writes about or quotes what is in it.

    It does where a noun of language comes right before it and a demonstrative after it. Filler and notices are quoted where quotation marks enclose them within a longer sentence, and are a headline's theme where a colon
    and a clause of their own follow; else the sentence without the window is judged by the model of mentions.
    """
    a, b = _sentence(c, lo, hi)
    x = np.r_[c[a:lo], np.uint8(32), c[hi:b]]
    if len(x) < 8:
        return False
    if _NAMED.search(c[a:lo].tobytes()) and _POINTED.search(c[max(lo, hi - 6) : b].tobytes()):
        return True
    if kind:
        before, after = c[a:lo].tobytes(), c[max(lo, hi - 4) : b].tobytes()  # a window may hold the closing mark
        if before.count(b'"') % 2 and b'"' in after and len(before.split()) + len(after.split()) >= 5:
            return True
        theme = c[a:b].tobytes().partition(b": ")
        if theme[2] and a + len(theme[0]) >= hi - 2 and len(theme[2].split()) >= 3 and float(_peaks(seeds.notices.ratio(_slots(c[a + len(theme[0]) + 2 : b], SEED_SLOTS), prose.loose.log(_slots(c[a + len(theme[0]) + 2 : b], SLOTS)), 3), np.zeros(b - a - len(theme[0]) - 2, bool)).max(initial=0.0)) < 20:
            return True
    ratio = seeds.mentions.ratio(_slots(x, SEED_SLOTS), prose.strict.log(_slots(x, SLOTS)), 5)
    return float(_peaks(ratio[3:], np.zeros(len(x) - 3, bool)).max(initial=0.0)) >= least


def find_residue(records: DataFrame, id_col: str = "article_id", title_col: str = "title", text_col: str = "content_text", phrases: Phrases | None = None, rare: tuple[float, float] = (0.004, 0.0003), template: float = 9.0, filler: float = 23.0, notice: float = 24.0, mention: float = 11.0, coverage: float = 0.0) -> DataFrame:
    """(id, kinds, covered) of records with residue: the sum of 1 template, 2 filler and 4 notice; covered is the share of characters in windows.

    ``template``, ``filler``, ``notice`` and ``mention`` are the log-likelihood ratios a window needs. Null titles and texts count as empty; empty
    records have no residue; texts are read whole. A repeated row is judged as often as it occurs; an empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    phrases = phrases or Phrases()
    kind = records.schema[id_col].dataType.simpleString()
    rows = records.select(F.col(id_col).cast("string").alias("id"), F.col(title_col).cast("string").alias("title"), F.col(text_col).cast("string").alias("text"))
    sc = rows.sparkSession.sparkContext
    seeds = sc.broadcast(seeded(phrases))
    prose = sc.broadcast(count_prose(rows, seeds, rare))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = prose.value
        for b in batches:
            kinds, marked, size = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for owners, c, begin in _streams(b["title"].tolist(), b["text"].tolist()):
                np.add.at(size, owners, np.diff(begin))
                mark = np.zeros(len(c), bool)
                for k, lo, hi in windows(c, model, seeds.value, (template, filler, notice)):
                    if not is_mention(c, k, lo, hi, model, seeds.value, mention):
                        mark[lo:hi] = True
                        kinds[owners[int(np.searchsorted(begin, lo, side="right")) - 1]] |= 1 << k
                np.add.at(marked, owners, np.add.reduceat(mark.astype(np.int64), begin[:-1]))
            at = np.flatnonzero((kinds > 0) & (marked > coverage * size))
            yield pd.DataFrame({"id": b["id"].to_numpy(object)[at], "kinds": kinds[at], "covered": marked[at] / size[at]})

    return rows.mapInPandas(run, "id string, kinds int, covered double").withColumn("id", F.col("id").cast(kind))


def without_residue(records: DataFrame, id_col: str = "article_id", **how) -> DataFrame:
    """The records without those that ``find_residue`` gives."""
    found = cut(find_residue(records, id_col, **how).select(F.col("id").alias("_gone")).distinct())
    return records.join(found, records[id_col] == found["_gone"], "left_anti")
