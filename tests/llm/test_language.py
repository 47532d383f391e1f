import itertools
import random

import pytest
from pyspark.sql import functions as F

from foliant.llm import language as L

SENTENCES = {
    "English": ["The {a} sailor counted the {b} garden near the gate.", "Every teacher in {a} noticed a {b} lamp because it was warm.", "What happens to the river if {a} removes the {b} stone?"],
    "Hinglish": ["{a} ne {b} ko dhyaan se dekha aur phir bagicha mein rakha.", "Iske baad {a} ke paas {b} ki toli ne nadi ko jaancha.", "Agle saal {a} ka {b} bahut purana nikla."],
    "Hindi": ["इसके बाद {a} ने बगीचा को बड़े ध्यान से देखा और {b} को रखा।", "अगले वर्ष {a} की टोली ने नदी को जाँचा क्योंकि {b} पुराना था।", "{a} के पास {b} का पुल है।"],
    "Marathi": ["त्यानंतर {a} ने बाग काळजीपूर्वक पाहिली आणि {b} ठेवले.", "पुढच्या वर्षी {a} च्या गटाने नदी तपासली कारण {b} जुने होते.", "{a} जवळ {b} येथील पूल आहे."],
}
NAMES = {"English": ["Velu", "Torma", "Kalno"], "Hinglish": ["Velu", "Torma", "Kalno"], "Hindi": ["वेलू", "तोरमा"], "Marathi": ["वेलू", "तोरमा"]}


def text(rng, language, n=8):
    return " ".join(rng.choice(SENTENCES[language]).format(a=rng.choice(NAMES[language]), b=rng.choice(NAMES[language])) for _ in range(n))


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        true = rng.choice(L.STATES)
        label = true if rng.random() < 0.8 else rng.choice([None, "", "unknown", *L.STATES])
        rows.append((str(i), text(rng, true), label, true))
    return spark.createDataFrame(rows, "id string, raw_text string, detected_language string, true string")


@pytest.fixture(scope="module")
def model(pages):
    return L.learn(pages, "id", "raw_text", "detected_language")


def test_held_out_accuracy(model):
    rng = random.Random(2)
    for language in L.STATES:
        got = [L.classify(text(rng, language, 4), model)[0] for _ in range(100)]
        assert got.count(language) >= 98


@pytest.mark.parametrize("a, b", itertools.permutations(L.STATES, 2))
def test_mixed_and_its_segments(model, a, b):
    rng = random.Random(3)
    x, y = text(rng, a, 6), text(rng, b, 6)
    language, confidence, segments, body = L.classify(f"{x} {y}", model)
    assert language == "Mixed" and [s[2] for s in segments] == [a, b] and 0.5 <= confidence <= 1
    assert abs(segments[1][0] - len(x)) < 40
    assert L.classify(f"{text(rng, a, 12)} {text(rng, b, 1)}", model)[0] == a


def test_viterbi_is_the_best_path():
    rng = random.Random(4)
    for _ in range(60):
        scores = [tuple(rng.uniform(-3, 3) for _ in range(3)) for _ in range(6)]
        value = lambda p: sum(e[s] for e, s in zip(scores, p, strict=True)) - 2.0 * sum(x != y for x, y in zip(p, p[1:], strict=False))
        best = max(itertools.product(range(3), repeat=6), key=value)
        assert value(L.viterbi(scores, 2.0)) == pytest.approx(value(best))


def test_the_short_way_gives_the_same(model):
    rng = random.Random(5)
    for language in L.STATES:
        t = text(rng, language, 3)
        states = L.viterbi([(s, -s, L.OFF_SCRIPT, L.OFF_SCRIPT) if w < "ऀ" else (L.OFF_SCRIPT, L.OFF_SCRIPT, s, -s) for w in L._WORD.findall(t.lower()) for s in [(model.latin if w < "ऀ" else model.devanagari).get(w, 0.0)]], L.SWITCH)
        assert {L.STATES[s] for s in states} == {language} == {s[2] for s in L.classify(t, model)[2]}


def test_other_languages_are_not_forced(model):
    french = "Les enfants marchaient lentement vers le village quand soudain la pluie recommença. Personne ne voulait rentrer, car il faisait encore chaud et le chemin semblait court."
    nepali = "उनीहरूले भोलिपल्ट बिहानै गाउँतिर लागेका थिए। त्यसपछि पानी परेकोले सबैजना घरभित्रै बसेर कुराकानी गर्न थालेका हुन् भन्ने सुनियो। केटाकेटीहरूले खेल्नुपर्ने ठाउँ खोजिरहेका छन् तर पाइएको छैन।"
    assert L.classify(french, model)[0] == L.classify(nepali, model)[0] == L.OTHER
    rng = random.Random(15)
    assert all(L.classify(text(rng, s, 4), model)[0] == s for s in L.STATES)


def test_confidence_tells_right_from_wrong(model):
    """The surer, the more often right: short pieces of two languages in one line, held out from what was learnt."""
    rng = random.Random(16)
    seen = []
    for _ in range(400):
        s = rng.choice(L.STATES)
        words = text(rng, s, 1).split()[: rng.choice([4, 6, 9])] + text(rng, rng.choice(L.STATES), 1).split()[:3]
        got, sure, _, _ = L.classify(" ".join(words) + ".", model)
        if got in L.STATES:
            seen.append((sure, got == s))
    seen.sort()
    half = len(seen) // 2
    right = lambda part: sum(r for _, r in part) / len(part)
    assert right(seen[half:]) >= right(seen[:half]) and right(seen[half:]) >= 0.9


def test_headings_do_not_count(model):
    rng = random.Random(6)
    head = "THE WARM GARDEN OF KALNO AND THE RIVER\n"
    assert L.classify(head + "\n".join(text(rng, "Hindi", 1) for _ in range(3)), model)[0] == "Hindi"


def test_garbled_text_counts_in_its_language(model):
    rng = random.Random(7)
    t = text(rng, "Marathi", 5)
    assert L.classify("".join(chr(c) for c in t.encode()), model)[0] == "Marathi"


@pytest.mark.parametrize("t", [None, "", " \n ", "12 × 3 = 36\n4 + 5 = 9", "— 7 —", "Word"])
def test_no_sentences(model, t):
    assert L.classify(t, model)[0] is None


def test_wrong_labels(spark, pages, model):
    found = {r.id: r.language for r in L.wrong_labels(pages, "id", "raw_text", "detected_language", model).collect()}
    want = {r.id: r.true for r in pages.where("detected_language is null or detected_language <> `true`").collect()}
    assert found == want
    rng = random.Random(8)
    hindi = text(rng, "Hindi")
    rows = [("a", hindi, "hin"), ("a", hindi, "हिन्दी"), ("b", hindi, "EN-in"), ("b", hindi, "EN-in"), ("c", hindi, " Und "), ("d", None, None), ("e", "", None), (None, hindi, None), ("f", hindi * 400, "Klingon")]
    df = spark.createDataFrame(rows, "id string, raw_text string, detected_language string").withColumn("l", F.lit(1)).withColumn("language", F.lit(1)).withColumn("t", F.lit(1))
    assert sorted((r.id, r.language) for r in L.wrong_labels(df, "id", "raw_text", "detected_language", model).collect()) == [("b", "Hindi"), ("b", "Hindi"), ("c", "Hindi"), ("f", "Hindi")]
    assert L.label_languages(df, "id", "raw_text", model).count() == 7
    assert L.wrong_labels(df.limit(0), "id", "raw_text", "detected_language").count() == 0
