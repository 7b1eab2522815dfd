import random

import pytest

from driftline.llm import language as L

TEXTS = {
    "de": "Der nächtliche Lauf hat heute wieder alle Zeilen kopiert und die alten Seiten nicht gelöscht. Wir müssen noch einmal prüfen, ob das stimmt. Niemand weiß, warum die Tabelle leer ist.",
    "en": "The nightly run has copied all the rows again and did not delete the old pages. We still have to check whether that is true. Nobody knows why the table is empty.",
    "es": "La pasada nocturna ha copiado otra vez todas las filas y no ha borrado las páginas antiguas. Todavía tenemos que comprobar si es verdad. Nadie sabe por qué la tabla está vacía.",
    "fr": "Le passage de nuit a encore copié toutes les lignes et n'a pas supprimé les anciennes pages. Nous devons encore vérifier si c'est vrai. Personne ne sait pourquoi le tableau est vide.",
    "it": "Il passaggio notturno ha copiato di nuovo tutte le righe e non ha cancellato le pagine vecchie. Dobbiamo ancora controllare se è vero. Nessuno sa perché la tabella è vuota.",
    "nl": "De nachtelijke ronde heeft alle rijen weer gekopieerd en de oude pagina's niet verwijderd. We moeten nog nagaan of dat klopt. Niemand weet waarom de tabel leeg is.",
    "pl": "Nocny przebieg znowu skopiował wszystkie wiersze i nie usunął starych stron. Musimy jeszcze sprawdzić, czy to prawda. Nikt nie wie, dlaczego tabela jest pusta.",
    "pt": "A passagem noturna copiou de novo todas as linhas e não apagou as páginas antigas. Ainda temos de verificar se é verdade. Ninguém sabe por que a tabela está vazia.",
    "ru": "Ночной обход снова скопировал все строки и не удалил старые страницы. Нам ещё надо проверить, правда ли это. Никто не знает, почему таблица пустая.",
    "sv": "Nattens körning har kopierat alla rader igen och tog inte bort de gamla sidorna. Vi måste fortfarande kontrollera om det stämmer. Ingen vet varför tabellen är tom.",
}


def sentences(lang):
    return [s.strip() + "." for s in TEXTS[lang].split(".") if s.strip()]


@pytest.fixture(scope="module")
def model():
    r, rows = random.Random(1), []
    for lang in L.CODES:
        for _ in range(60):
            label = lang if r.random() < 0.9 else r.choice(L.CODES)
            rows.append(("\n".join(r.sample(sentences(lang), 2)), label))
    return L.train(rows)


def test_codewords_are_far_apart():
    m = L.codewords()
    assert m.shape == (len(L.CODES), L.BITS)
    assert min((m[i] != m[j]).sum() for i in range(len(m)) for j in range(i)) >= 4


def test_documents_and_mixed_lines(model):
    d = L.Decoder(model)
    for lang in L.CODES:
        k, sure, lines = d.document("\n".join(sentences(lang)))
        assert L.CODES[k] == lang and sure > 0.5 and lines == []
        assert L.CODES[d.document(TEXTS[lang].upper())[0]] == lang
    k, _, lines = d.document("\n\n".join([*sentences("de"), sentences("fr")[0]]))
    assert L.CODES[k] == "de" and [L.CODES[i] for i, _ in lines] == ["de", "de", "de", "fr"]
    assert d.document(None) == (-1, 0.0, []) and d.document("  \n ")[0] == -1 and d.document("1234 --- 99")[0] == -1
    long = d.document(TEXTS["sv"] * 3000)
    assert L.CODES[long[0]] == "sv" and long[2] == []


def test_labels_in_any_spelling(spark):
    rows = [("de",), ("DEU",), ("ger",), ("German",), ("de_AT",), (" de-CH ",), ("und",), ("",), (None,), ("xx",), ("English",)]
    got = [r.c for r in spark.createDataFrame(rows, "lang string").select(L.label_code(L.F.col("lang")).alias("c")).collect()]
    assert got == ["de"] * 6 + [None] * 4 + ["en"]


def test_corrections(spark, model):
    mixed = "\n".join([*sentences("en"), sentences("ru")[0]])
    rows = [(1, TEXTS["de"], "de"), (2, TEXTS["de"], "English"), (3, TEXTS["fr"], None), (4, mixed, "en"), (5, None, None), (6, "", "de"), (2, TEXTS["de"], "English")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, label string, seg_no int")
    got = sorted(map(tuple, L.label_corrections(df, model).collect()))
    assert got == [(2, -1, "de"), (2, -1, "de"), (3, -1, "fr"), (4, 0, "en"), (4, 1, "en"), (4, 2, "en"), (4, 3, "ru")]
    assert L.label_corrections(df.limit(0), model).count() == 0
    assert L.training_rows(df.limit(0)) == [] and {c for _, c in L.training_rows(df)} == {"de", "en"}


def test_held_out_accuracy(model):
    d, r, right, n = L.Decoder(model), random.Random(5), 0, 0
    for lang in L.CODES:
        for _ in range(10):
            ws = TEXTS[lang].split()
            at = r.randrange(len(ws) - 9)
            n += 1
            right += L.CODES[d.document(" ".join(ws[at : at + 9]))[0]] == lang
    assert right / n >= 0.95


def test_a_run_of_short_lines_is_a_segment_and_lines_have_margins_of_their_own(model):
    d = L.Decoder(model)
    short = ["Общий обзор", "Новые задачи", "Важные решения", "Список участников", "Следующие шаги", "Открытые вопросы", "Главные выводы", "Наши планы"]
    k, sure, lines = d.document("\n".join([*sentences("en"), *short]))
    assert L.CODES[k] in ("en", "ru") and [L.CODES[i] for i, _ in lines][-8:] == ["ru"] * 8 and lines[0][0] == L.CODES.index("en")
    assert sure > 0.9 and len({c for _, c in lines}) > 6


def test_the_sample_is_the_same_however_rows_are_split(spark):
    rows = [(i, "\n".join(f"{TEXTS[lang][:60]} number {i} line {k}" for k in range(6)), lang) for i, lang in enumerate(L.CODES * 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    one = L.training_rows(df.repartition(1), lines_per_label=20)
    assert one == L.training_rows(df.repartition(7), lines_per_label=20)
    assert len(one) == 20 * len(L.CODES)


def test_the_model_is_kept_for_the_same_files(spark, tmp_path, monkeypatch):
    rows = [(i, TEXTS[lang], lang) for i, lang in enumerate(L.CODES * 3)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    first = L.trained(df)
    monkeypatch.setattr(L, "train", lambda rows: 1 / 0)
    again = L.trained(df)
    assert all((getattr(first, n) == getattr(again, n)).all() for n in vars(first))
