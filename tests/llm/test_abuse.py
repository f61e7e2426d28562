import itertools

import pytest

from spanloom.llm import abuse

CASES = [
    "You are a worthless id1ot, now get lost.",
    "@katja, you are a stupid a s s h o l e.",
    "Only your mother does not see that you are pathetic s#um.",
    "Du bist ein Vollidiooooot, halt endlich die Fresse!",
    "Vous êtes tous un c*nnard fini.",
    "Eres un gilipol**s sin remedio, cierra la boca.",
    "Ты жалкая мразь, заткнись.",
    "All migrants are v3rm1n and should be driven out.",
    "Les réfugiés sont de la ver­mine.",
    "Los extranjeros son r-a-t-a-s.",
    "Женщины это паразиты, гнать их отсюда.",
    "Horny singles near you want s3x tonight.",
    "She took his hard сосk in her mouth.",
    "Beаst of a page. Free p_o_r_n clips.",
]
PLAIN = [
    "Our rules forbid hate speech, insults, threats and pornographic images.",
    "The rat officer will treat the drains for parasites on Monday.",
    "A pair of great tits was seen near the cock pheasant pen.",
    "To stop the job, kill the parent process and let the orphan child die.",
    "The clinic explains breast self-examination and when to see a doctor about nipple discharge.",
    "The historian shows how propaganda once likened women to vermin.",
    "I was such a fool to miss the sale, silly me.",
    "This kettle is rubbish and the lid is ugly, I want my money back.",
    "El juez condenó a un hombre por insultar a refugiados.",
    "Shiitake and cocktail onions go well with this classic bass.",
    "Version 2.0 of mallowshore3.invalid, 256 Hz, € 15!!",
]


#: Sentences of no labelled line: cases by language, then plain ones.
HELD_OUT = {
    "en": ["I'm going to murder your whole family", "I hope you get raped", "Kikes run the banks", "n1gg3rs should leave", "She stroked his erect penis until he ejaculated", "Those people are all savages and should be wiped out", "You worthless idiot, go see a doctor", "You are a pathetic moron and I will stab you", "Refugees are cockroaches, deport them all", "You @sshole, leave"],
    "de": ["Du bist ein elender Wichser", "Ich werde dich abstechen, du Hurensohn", "Juden sind Ratten", "Halt die Fresse, Arschloch", "Sie lutschte seinen harten Schwanz", "Zigeuner sind Ungeziefer und müssen raus"],
    "es": ["Eres una basura, cabrón", "Te voy a romper la cara, maldito", "Los moros son cucarachas, fuera de aquí", "Voy a matar a tu madre, hijo de puta", "Ella le chupaba la polla desnuda", "Los gitanos son ratas y ladrones"],
    "fr": ["Tu es une grosse merde, connard", "Je vais te tuer, salope", "Les arabes sont des rats", "Ferme ta gueule, pauvre con", "Elle suce sa grosse bite", "Les juifs sont de la vermine, il faut les chasser"],
    "ru": ["Ты тупая тварь", "Я тебя убью, сука", "Евреи это крысы, гнать их вон", "Заткнись, мудак", "Она трахалась с ним всю ночь, голая", "Мигранты это нелюди"],
    "ja": ["お前は本当にクズ野郎だ", "お前を殺しに行く", "移民はゴキブリだ", "死ね、バカ野郎", "無修正のセックス動画", "外国人は害虫だから出て行け"],
}
HELD_OUT_PLAIN = ["Refugees deserve a warm welcome", "A man was convicted of stabbing his neighbour", "This page is about breast cancer", "Kill the process with ctrl c", "My dog got hurt yesterday", "Der Arzt untersucht die Brust der Patientin", "La policía detuvo al hombre que quería matar a su vecino", "Le médecin parle de la santé des femmes", "Врач говорит о здоровье женщин", "警察は男を逮捕した", "He is user12 and has an mp3 player", "The women of the village sing on Sunday"]


@pytest.fixture(scope="module")
def scorer(spark):
    text = " ".join(PLAIN) * 3 + " sit sat set not net mother father better letter"
    df = spark.createDataFrame([(text,)], "text string")
    return abuse.Scorer({r["trigram"]: float(r["n"]) for r in abuse.trigram_counts(df).collect()}, abuse.fitted(abuse.plain_sample(df)))


@pytest.mark.parametrize("text", CASES)
def test_cases(scorer, text):
    assert max(scorer.score("Weather was fine. " + text + " More to come.")) >= abuse.THRESHOLD


@pytest.mark.parametrize("text", PLAIN)
def test_plain(scorer, text):
    assert max(scorer.score(text)) < abuse.THRESHOLD


@pytest.mark.parametrize("language", HELD_OUT)
def test_held_out(scorer, language):
    assert [t for t in HELD_OUT[language] if max(scorer.score(t)) < abuse.THRESHOLD] == []


def test_held_out_plain(scorer):
    assert [t for t in HELD_OUT_PLAIN if max(scorer.score(t)) >= abuse.THRESHOLD] == []


def test_lines_left_out_of_the_fit():
    """Held-out recall over a fifth of the labelled lines by language, and false alarms."""
    model = abuse.fitted((), 1)
    scorer = abuse.Scorer({}, model)
    got = {}
    for language, sentence, kinds in abuse.labelled.sample(only=1):
        got.setdefault((language, any(kinds)), []).append(scorer.restored_scores([abuse.fold(sentence)]).max() >= abuse.THRESHOLD)
    recall = {language: sum(x) / len(x) for (language, case), x in got.items() if case}
    alarms = [y for (_, case), x in got.items() if not case for y in x]
    print(recall, sum(alarms) / len(alarms))
    assert sum(recall.values()) / len(recall) > 0.8 and sum(alarms) / len(alarms) < 0.3


def all_readings(restorer, token):
    """Every reading of a token's lattice with its weight, one by one."""
    for choice in itertools.product(*restorer.lattice(token)):
        text = "".join(x for x, _ in choice)
        score, context = -sum(cost for _, cost in choice), "  "
        for c in text + " ":
            score, context = score + restorer.model.log(context, c), context[1] + c
        yield score + abuse.LISTED_BONUS * restorer.listed(text), text


@pytest.mark.parametrize("token", ["455h0l3", "f*ck", "sh1t", "b1tch35", "p0rn", "w_h_0", "1d10t", "u_r_dumb", "n00b", "$lut", "6u1t4r", "m0t_er", "tr4nsp0rt"])
def test_decoding_finds_the_best_of_all_readings(scorer, token):
    r = scorer.restorer
    best = max(all_readings(r, token))
    weight = {text: score for score, text in all_readings(r, token)}
    assert weight[r.decode(token)] == pytest.approx(best[0])


def test_long_runs_are_read_whole(scorer):
    assert scorer.restorer.decode("very_" * 12 + "5tup1d") .endswith("stupid")


def test_names_stay_unless_they_read_as_listed(scorer):
    for noisy, clean in (("whor3", "whore"), ("porn0", "porno"), ("@sshole", "asshole"), ("!diot", "idiot"), ("rikka7", "rikka7"), ("@katja", "@katja"), ("50cm", "50cm")):
        assert scorer.restorer.restore(noisy) == clean


def test_long_sentences_are_scored_in_stretches(scorer):
    for n in (30, 100, 1000):
        text = "word " * n + "you are a stupid asshole " + "word " * n
        assert scorer.score(text)[0] >= abuse.THRESHOLD
    assert max(scorer.score("word " * 5000)) < abuse.THRESHOLD and max(scorer.score("猫" * 5000)) < abuse.THRESHOLD


def test_restoring(scorer):
    for noisy, clean in (("455h0l3", "asshole"), ("f-u-c-k", "fuck"), ("п о р н о", "порно"), ("un$$ziefer", "ungeziefer"), ("раrаsіtеs", "parasites"), ("naaaaaked", "naked"), ("rikka7", "rikka7"), ("quiet", "quiet")):
        assert scorer.restorer.restore(noisy) == clean


def test_false_charset(scorer):
    bad = "Los inmigrantes son parásitos y no merecen vivir".encode().decode("cp1252")
    assert max(scorer.score(bad)) >= abuse.THRESHOLD


def test_frames(spark):
    data = [(1, "s", CASES[0]), (1, "s", CASES[0]), (2, "s", None), (3, None, ""), (4, None, "   "), (5, "t", "x" * 200_000), (6, "t", "word " * 40_000 + CASES[5])]
    df = spark.createDataFrame([(*d, 1.0) for d in data], "doc_id long, source string, text string, score double")
    scored = abuse.scores(df, ["doc_id", "source"])
    assert sorted(r["doc_id"] for r in scored.where(f"score >= {abuse.THRESHOLD}").collect()) == [1, 1, 6]
    rates = {r["source"]: (r["documents"], r["cases"]) for r in abuse.rates(scored).collect()}
    assert rates == {"s": (3, 2), None: (2, 0), "t": (2, 1)}
    assert abuse.scores(df.limit(0), ["doc_id"]).count() == 0
