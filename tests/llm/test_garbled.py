import numpy as np
import pytest

from hoopflow.llm import garbled as g

CLEAN = [
    "El capitán falló diez tiros y pidió perdón a la afición, según el club.", "Après une fin de match tendue, la défense a été très agressive dès l’entrée en jeu.",
    "Die Mannschaft übte am Dienstag das Überzahlspiel, die Bänder sind gedehnt.", "Η ομάδα νίκησε στην αγωνιστική και ο προπονητής μίλησε για την άμυνα.",
    "Тренер је похвалио одбрану, али није био задовољан скоком.", "Žiūrovai džiaugėsi iki paskutinės sekundės, treneris gyrė gynybą.",
    "İkinci yarıda ribaunt üstünlüğü değişti ve takım liderliğini sürdürdü.", "“We stopped running,” he said — nothing but net…", "só em Portugal não há atenção à equipa; a próxima viagem é amanhã.",
]


def corpus(spark, extra=()):
    rows = [(i, t) for i, t in enumerate(CLEAN * 60)]
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string")


def wrong(t, stored, read):
    return t.encode(stored).decode(read)


CASES = [
    (9000, wrong(CLEAN[0], "utf-8", "latin-1"), CLEAN[0]), (9001, wrong(CLEAN[1], "utf-8", "cp850"), CLEAN[1]), (9002, wrong(wrong(CLEAN[2], "utf-8", "latin-1"), "utf-8", "latin-1"), CLEAN[2]),
    (9003, wrong(CLEAN[3], "cp1253", "latin-1"), CLEAN[3]), (9004, wrong(CLEAN[4], "utf-8", "mac_roman"), CLEAN[4]), (9005, CLEAN[5] + " " + wrong(CLEAN[0], "utf-8", "cp437"), CLEAN[5] + " " + CLEAN[0]),
    (9006, "Viva el capit" + wrong("á", "utf-8", "cp1252") + "n, siempre.", "Viva el capitán, siempre."),
]
SOUND = [
    (9100, None), (9101, ""), (9102, "   "), (9103, "plain ASCII only"), (9104, "The feed printed “Ã©” where the sheet has “é”."), (9105, "The board shows � for letters its font lacks."),
    (9108, "Export note: ‘â€™’ in old files stands for an apostrophe."), (9106, "Currency column shows € and £, temperatures in °C."), (9107, "capitán " * 5000),
]


@pytest.fixture(scope="module")
def found(spark):
    return {r["doc_id"]: r for r in g.garbled(corpus(spark, [(i, t) for i, t, _ in CASES] + SOUND + [(9200, "El capit�n fall� diez tiros"), (9000, CASES[0][1])])).collect()}


def test_finds_and_restores(found):
    assert sorted(found) == sorted([i for i, _, _ in CASES] + [9200])
    assert {i: found[i]["restored"] for i, _, _ in CASES} == {i: want for i, _, want in CASES}
    assert not found[9200]["whole"] and "lost" in found[9200]["encodings"]


def test_nothing_to_do(spark):
    assert g.garbled(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert g.garbled(spark.createDataFrame([(1, None), (2, "ascii")], "doc_id long, text string")).count() == 0


def test_texts_are_labelled_alike_alone_and_in_a_batch():
    rng = np.random.default_rng(2)
    blocks = [rng.normal(-6, 4, (int(n), 1 + 5)).astype("float32") for n in rng.integers(1, 60, 40)]
    together = g.viterbi(blocks)
    for b, path in zip(blocks, together):
        assert (g.viterbi([b])[0] == path).all()


def test_the_path_is_the_best_one():
    rng = np.random.default_rng(4)
    for _ in range(20):
        e = rng.normal(-6, 8, (4, 3)).astype("float32")

        def score(path):
            s, before = 0.0, 0
            for i, x in enumerate(path):
                if x != before:
                    s += g.LEAVE if x == 0 else g.ENTER if before == 0 else g.SWITCH
                s += e[i, x]
                before = x
            return s + (g.LEAVE if before else 0)

        import itertools

        best = max(score(p) for p in itertools.product(range(3), repeat=4))
        assert score(tuple(int(x) for x in g.viterbi([e])[0])) == pytest.approx(best, abs=1e-3)
