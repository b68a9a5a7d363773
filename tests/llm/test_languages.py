import random

import numpy as np
import pytest

from peerlens.llm.languages import NAMES, Model, fit, label_code, languages, mended_labels, stretches, words_in, words_of
from pyspark.sql import functions as F

SENTENCES = {
    "en": ["the owner told us that the glass shelf is new", "there should be no other shop in this folder", "we checked the picture again after the rain", "the agent reached the market before closing time"],
    "es": ["la dueña nos dijo que el letrero es de este año", "no debería haber ninguna otra tienda en la carpeta", "hemos revisado otra vez la entrada después de la lluvia", "el agente llegó al mercado antes del cierre"],
    "pt": ["a dona nos disse que a prateleira de vidro é deste ano", "não deveria haver nenhuma outra loja nesta pasta", "nós conferimos de novo a entrada depois da chuva", "o agente chegou à loja antes de fechar e viu tudo"],
    "fr": ["la patronne nous a dit que le comptoir date de cette année", "il ne devrait y avoir aucun autre magasin dans ce dossier", "nous avons encore vérifié l'étal voisin après la pluie", "l'agent est arrivé chez le voisin avant la fermeture"],
    "de": ["die inhaberin sagte uns dass der eingang aus diesem jahr stammt", "in diesem ordner dürfte es keinen anderen laden geben", "wir haben nach dem regen noch einmal nachgesehen", "der prüfer kam kurz vor ladenschluss an den markt"],
    "id": ["pemilik toko berkata kepada kami bahwa rak kaca itu baru", "seharusnya tidak ada toko lain di dalam map ini", "kami sudah memeriksa pintu sekali lagi setelah hujan", "petugas tiba di toko sebelum tutup dan melihat papan nama"],
    "hi": ["मालिक ने बताया कि काँच का रैक इस साल का है", "इस फोल्डर में किसी और दुकान की फोटो नहीं होनी चाहिए", "हमने बारिश के बाद फिर से देखा कि दाम सही है", "हमारा कर्मचारी दुकान पर बंद होने से पहले पहुँचा"],
    "bn": ["মালিক বললেন যে কাচের তাক গত মাসে আনা হয়েছে", "এই ফোল্ডারে অন্য কোনো দোকানের ছবি থাকার কথা নয়", "malik bollen je kacher tak goto mashe ana hoyechhe ekhane", "ei foldere onno kono dokaner chhobi thakar kotha noy"],
}
DOCS = "doc_id long, text string, lang string, key string"


def corpus(seed, n, wrong=0.1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        code = rng.choice(list(SENTENCES))
        text = ". ".join(rng.choice(SENTENCES[code]) for _ in range(rng.randrange(2, 6)))
        label = rng.choice(NAMES[code]) if rng.random() > wrong else rng.choice(["und", "", None, "-", rng.choice([c for c in SENTENCES if c != code])])
        rows.append((i, text, label, code))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(corpus(0, 600), DOCS)
    from peerlens.llm.languages import fit_on

    return fit_on(df, "doc_id", "text", "lang")


def test_labels(spark):
    data = ["en", " EN", "en-GB", "en_US", "English", "pt-BR", "Bangla", "id_ID", "ger", "und", "-", "??", "", " ", None, "it", "हिन्दी", "por"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in data], "l string").select(label_code(F.col("l"))).collect()]
    assert got == ["en"] * 5 + ["pt", "bn", "id", "de"] + [None] * 7 + ["hi", "pt"]


def test_held_out_accuracy(spark, model):
    rows = corpus(1, 800)
    got = {r.doc_id: r for r in languages(spark.createDataFrame(rows, DOCS), "doc_id", "text", model).where("seg_no = 0").collect()}
    right = sum(got[i].lang == code for i, _, _, code in rows)
    assert right / len(rows) >= 0.99 and all(0 < r.confidence <= 1 for r in got.values())


def test_stretches_of_mixed_documents(spark, model):
    rng = random.Random(2)
    rows, want = [], {}
    for i in range(300):
        codes = [rng.choice(list(SENTENCES))]
        while len(codes) < rng.randrange(2, 5):
            codes.append(rng.choice([c for c in SENTENCES if c != codes[-1]]))
        rows.append((i, "\n".join(". ".join(rng.choice(SENTENCES[c]) for _ in range(rng.randrange(2, 4))) for c in codes), None, ""))
        want[i] = codes
    got = {}
    for r in languages(spark.createDataFrame(rows, DOCS), "doc_id", "text", model).where("seg_no > 0").orderBy("doc_id", "seg_no").collect():
        got.setdefault(r.doc_id, []).append(r.lang)
    assert sum(got.get(i) == want[i] for i in want) / len(want) >= 0.97


def test_short_quotes_are_no_stretches(spark, model):
    text = ". ".join(SENTENCES["en"]) + ' "porque el dueño no estaba" ' + ". ".join(SENTENCES["en"])
    rows = languages(spark.createDataFrame([(1, text, None, "")], DOCS), "doc_id", "text", model).collect()
    assert [(r.seg_no, r.lang) for r in rows] == [(0, "en")]


def test_missing_and_wrong_labels(spark):
    rows = corpus(3, 500) + [(1000, None, "en", ""), (1001, "", None, ""), (1002, " 12 / 7 = ?", "", ""), (1003, "0x06E5DAD7 12:11 #8222 https://a.b/c", None, ""), (1004, "x" * 5000, None, "")]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.lang for r in mended_labels(df, "doc_id", "text", "lang").collect() if r.seg_no == 0}
    known = {n: c for c, names in NAMES.items() for n in names}
    want = {i: code for i, _, label, code in rows[:500] if known.get(label) != code}
    assert got == want


def test_words():
    assert words_of("See https://x.y/z?a=b <b>Café</b> {\"conf\": 0.6, \"box\": [1]} image_01.jpg A1 l'étal n°5") == ["see", "café", "l'étal", "n"]


def test_words_of_records_and_long_words():
    assert words_of('{"note": "hello there my friend", "code": "xk", "conf": 0.3}') == ["hello", "there", "my", "friend"]
    long = "donaudampfschifffahrtselektrizitätenhauptbetriebswerk"
    assert words_of(f"das {long} und hahaha{'ha' * 30} <a {'x' * 500}>hier</a>") == ["das", long, "und", "hier"]
    assert words_of("#tag a_b ¿qué? 12th \u00adsoft\u00adly 'tis") == ["qué", "softly", "tis"]


def test_words_of_many_texts_are_those_of_each():
    rng = random.Random(2)
    texts = [rng.choice([None, "", " ", "\n", "a\nb", "x\u200by z", "ভাষা", "’s"]) if rng.random() < 0.3 else rng.choice(SENTENCES[rng.choice(list(SENTENCES))]) for _ in range(300)]
    found, at = words_in(texts), 0
    for text, n in zip(texts, found.counts):
        assert [found.distinct[i] for i in found.ids[at : at + n]] == words_of(text or "")
        at += n
    assert at == len(found.ids)


def test_paths_of_many_texts_are_those_of_each():
    from peerlens.llm.languages import best_paths, mixed_texts

    rng = np.random.default_rng(6)
    counts = rng.integers(1, 60, 40)
    scores = np.maximum(-np.abs(rng.normal(size=(counts.sum(), 4))) * 6, -6)
    path, (main, mixed), at = best_paths(scores, counts), mixed_texts(scores, counts), 0
    for n, m, x in zip(counts, main, mixed):
        one = scores[at : at + n]
        assert (best_paths(one, np.array([n])) == path[at : at + n]).all()
        assert x or (path[at : at + n] == m).all()
        at += n


def test_stretches_rules():
    a, b = [0.0, -5.0], [-5.0, 0.0]
    assert stretches(np.array([a] * 20 + [b] * 7 + [a] * 20), 6, 8) == [(0, 47, 0)]
    assert stretches(np.array([a] * 20 + [b] * 8 + [a] * 20), 6, 8) == [(0, 20, 0), (20, 28, 1), (28, 48, 0)]
    assert stretches(np.empty((0, 2))) == [] and stretches(np.array([b] * 3)) == [(0, 3, 1)]


def test_stretches_of_eight_words_in_close_languages(spark, model):
    a, b = [0.0, -2.5], [-2.5, 0.0]
    assert stretches(np.array([a] * 20 + [b] * 8 + [a] * 20)) == [(0, 20, 0), (20, 28, 1), (28, 48, 0)]
    close = ("es", "pt", "fr")
    kept = []
    for outer in close:
        for inner in (c for c in close if c != outer):
            for sentence in SENTENCES[inner]:
                for n in (8, 10, 12):
                    if len(words := words_of(sentence)) >= n:
                        text = words_of(". ".join(SENTENCES[outer]))
                        scores = model.word_scores(text + words[:n] + text)
                        kept.append(inner in {model.codes[c] for _, _, c in stretches(scores)})
    assert len(kept) > 30 and sum(kept) / len(kept) >= 0.9, (len(kept), sum(kept))


def test_nothing_to_fit_on(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mended_labels(empty, "doc_id", "text", "lang").count() == 0
    assert isinstance(fit(words_in([]), [], ("en", "es")), Model)


def test_joining_equals_the_plain_way():
    """The same as looking for the shortest stretch again and again."""
    from peerlens.llm.languages import joined

    rng = np.random.default_rng(4)
    for _ in range(200):
        parts, at, kind = [], 0, -1
        for _ in range(rng.integers(1, 12)):
            kind = rng.choice([k for k in range(3) if k != kind])
            parts.append((at, at + int(rng.integers(1, 14)), int(kind)))
            at = parts[-1][1]
        scores = rng.normal(size=(at, 3))
        want = list(parts)
        while len(want) > 1:
            i = min(range(len(want)), key=lambda k: (want[k][1] - want[k][0], want[k][0]))
            if want[i][1] - want[i][0] >= 8:
                break
            near = [k for k in (i - 1, i + 1) if 0 <= k < len(want)]
            to = max(near, key=lambda k: scores[want[i][0] : want[i][1]].sum(0)[want[k][2]])
            want[i] = (want[i][0], want[i][1], want[to][2])
            merged = [want[0]]
            for p in want[1:]:
                merged[-1:] = [(merged[-1][0], p[1], p[2])] if p[2] == merged[-1][2] else [merged[-1], p]
            want = merged
        assert joined(parts, scores, 8) == want


def test_very_long_document(spark, model):
    text = "\n".join(". ".join(SENTENCES[c] * 40) for c in ("en", "hi", "de") * 20)
    rows = languages(spark.createDataFrame([(1, text, None, "")], DOCS), "doc_id", "text", model).orderBy("seg_no").collect()
    assert [r.lang for r in rows[1:]] == ["en", "hi", "de"] * 20
