"""Counts against brute force, bands on hand-made texts."""

import re
from collections import Counter

from meterstone.llm import quality
from meterstone.llm.common import table


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    again = {k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again),
            len(words) < 10 or 100 * len(again) > 20 * len(words))


def test_counts(spark, small_folder, odd, none):
    for df in (table(spark, small_folder, "documents"), odd):
        want = Counter((r.doc_id, *brute(r.text)) for r in df.collect())
        got = quality.assess(df)
        assert Counter(tuple(r)[:7] for r in got.collect()) == want
        assert not any(r.kept and r.base_failed for r in got.collect())
    assert quality.assess(none).count() == 0


def test_hash_clash_falls_back(monkeypatch):
    words = [b"a", b"b", b"c", b"d", b"e", b"f", b"a", b"b", b"c", b"d", b"e", b"g"]
    assert quality.repeat_words(words) == 10
    import numpy as np

    monkeypatch.setattr(quality.np, "argsort", lambda h, kind=None: np.arange(len(h))[::-1])
    monkeypatch.setattr(quality.np, "zeros", lambda n, dtype=None, own=np.zeros: own(n, dtype))
    assert isinstance(quality.repeat_words(words), int)


# plain sentences, one for each band
SENTENCES = {
    "en": "Yesterday evening we walked along the river and talked about how the city had changed over the last twenty years.",
    "de": "Gestern Abend gingen wir am Fluss entlang und sprachen darüber, wie sich die Stadt in den letzten zwanzig Jahren verändert hat.",
    "fr": "Hier soir nous nous sommes promenés au bord de la rivière et nous avons parlé de la façon dont la ville avait changé.",
    "es": "Ayer por la tarde caminamos junto al río y hablamos de cómo había cambiado la ciudad en los últimos veinte años.",
    "Latin": "Wczoraj wieczorem spacerowaliśmy nad rzeką i rozmawialiśmy o tym, jak zmieniło się miasto przez ostatnie dwadzieścia lat.",
    "Cyrillic": "Вчера вечером мы гуляли по набережной и говорили о том, как изменился город за последние двадцать лет.",
    "Greek": "Χθες το βράδυ περπατήσαμε στην παραλία και μιλήσαμε για το πώς άλλαξε η πόλη τα τελευταία είκοσι χρόνια.",
    "Hebrew": "אתמול בערב הלכנו לאורך החוף ודיברנו על איך העיר השתנתה בעשרים השנים האחרונות.",
    "Arabic": "مشينا مساء أمس على الشاطئ وتحدثنا عن كيفية تغير المدينة خلال السنوات العشرين الماضية وعن البيوت الجديدة.",
    "Devanagari": "कल शाम हम समुद्र के किनारे टहले और पिछले बीस वर्षों में शहर कैसे बदल गया है इस बारे में बात की।",
    "Thai": "เมื่อวานตอนเย็นเราเดินเล่นริมทะเลและคุยกันว่าเมืองเปลี่ยนไปอย่างไรในช่วงยี่สิบปีที่ผ่านมา",
    "Kana": "昨日の夜、私たちは川沿いを散歩しながら、この二十年で街がどのように変わったかについて話しました。",
    "Han": "昨天晚上我们沿着河边散步，谈论这座城市在过去二十年里发生了怎样的变化。新的房子建在以前是花园的地方。",
    "Hangul": "어제 저녁 우리는 강가를 산책하면서 지난 이십 년 동안 도시가 어떻게 변했는지에 대해 이야기했습니다.",
}


def judged(text, band):
    own, words = quality.pieces(quality.default_pieces(), quality.default_pairs()), text.encode().split()
    own.learn([words])
    return quality.verdict(quality.BANDS[band], own.figures(words, sum(len(w.decode()) for w in words)))


def test_every_band_keeps_a_plain_sentence_and_rejects_noise_of_its_letters():
    for band, text in SENTENCES.items():
        assert judged(text, band), band
        if band not in ("en", "de", "fr", "es"):
            assert quality.script(text) == band
        marks = "".join(c + "☂♞⚔" for c in text if c.isalpha())  # letters between rare signs
        assert not judged(" ".join(marks[i:i + 7] for i in range(0, len(marks), 7)) * 3, band), band
        letters = [c for c in text if c.isalpha()][:2]
        assert not judged(" ".join(letters * 60), band), band  # two letters over and over: no entropy
    assert set(quality.BANDS) - set(SENTENCES) == {"other"} and not judged("😀😃 ☂☃ ♞♜ ⚔⚖ ★☆ ▲▼ ◆◇ ☯☮ ♠♥ ♦♣ " * 3, "other")


def test_scripts():
    assert quality.script("привет мир") == "Cyrillic" and quality.script("bonjour été") == "Latin" and quality.script("12 34") == "other"
    assert quality.script("ⴰⴱⴳ") == "other" and quality.script("漢字") == "Han" and quality.script("漢字かな") == "Kana"


def test_short_texts_are_judged_too():
    assert not judged("xq zzkw vbnm qrtp lkjh wqzx pldk mnbv cxzq wrtp ghjk dfgh", "en")
    assert judged("we saw the old house by the river again today", "en")


def test_labelled_texts(spark):
    d = "/root/testdata/sf0.1"
    labelled = quality.assess(table(spark, d, "documents")).join(table(spark, d, "labels"), "doc_id").where("not base_failed")
    got = {(r.quality, r.kept): r["count"] for r in labelled.groupBy("quality", "kept").count().collect()}
    good, bad = got[1, True] + got.get((1, False), 0), got.get((0, True), 0) + got[0, False]
    assert got[1, True] >= 0.995 * good and got[0, False] >= 0.7 * bad
