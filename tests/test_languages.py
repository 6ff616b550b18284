"""The learned model of languages: held-out rows, each language, odd input."""

import pytest
from pyspark.sql import functions as F

from feedmill.operators import languages

SAMPLES = {
    "de": "Die Staatsanwaltschaft hat gegen das Unternehmen Ermittlungen wegen des Verdachts auf Betrug eingeleitet und mehrere Räume durchsucht",
    "en": "The department has opened an investigation into the company for alleged fraud and searched several of the offices in the city",
    "fr": "Le parquet a ouvert une enquête sur la société pour des soupçons de corruption et plusieurs bureaux ont été fouillés",
    "es": "La fiscalía ha abierto una investigación sobre la empresa por presuntos delitos de corrupción y registró varias oficinas",
    "it": "La procura ha aperto una indagine sulla società per presunti reati di corruzione e ha perquisito diversi uffici della città",
    "nl": "Het openbaar ministerie heeft een onderzoek naar het bedrijf geopend wegens vermoedelijke fraude en doorzocht enkele kantoren",
    "pl": "Prokuratura wszczęła śledztwo przeciwko spółce w sprawie podejrzenia oszustwa i przeszukała kilka biur w mieście",
    "pt": "O ministério público abriu uma investigação sobre a empresa por suspeitas de corrupção e revistou vários escritórios",
    "ru": "Прокуратура начала расследование против компании по подозрению в мошенничестве и обыскала несколько офисов",
    "uk": "Прокуратура розпочала розслідування щодо компанії за підозрою в шахрайстві та обшукала кілька офісів у місті",
    "cs": "Státní zastupitelství zahájilo vyšetřování společnosti pro podezření z podvodu a prohledalo několik kanceláří ve městě",
    "da": "Anklagemyndigheden har indledt en undersøgelse af selskabet for mistanke om svindel og ransagede flere kontorer i byen",
    "fi": "Syyttäjä on aloittanut tutkinnan yhtiötä vastaan epäillystä petoksesta ja teki kotietsinnän useisiin toimistoihin",
    "hu": "Az ügyészség nyomozást indított a vállalat ellen csalás gyanúja miatt és átkutatott több irodát a városban",
    "no": "Påtalemyndigheten har åpnet etterforskning av selskapet etter mistanke om bedrageri og ransaket flere kontorer i byen",
    "sv": "Åklagaren har inlett en förundersökning mot bolaget för misstänkt bedrägeri och genomsökte flera kontor i staden",
    "tr": "Savcılık şirket hakkında dolandırıcılık şüphesiyle soruşturma başlattı ve şehirdeki birkaç ofiste arama yaptı",
    "ja": "検察は会社に対して詐欺の疑いで捜査を開始し、市内のいくつかの事務所を捜索しました。捜査は続いています。会社はまだ何も述べていません。",
    "zh": "检察院因涉嫌欺诈对该公司展开调查并搜查了该市的几个办公室调查仍在继续公司尚未对此发表任何评论记者将继续关注此事的后续发展情况",
    "ko": "검찰은 사기 혐의로 회사에 대한 수사를 시작하고 시내의 여러 사무실을 압수 수색했습니다 수사는 계속되고 있습니다",
    "ar": "فتحت النيابة العامة تحقيقا مع الشركة للاشتباه في الاحتيال وفتشت عدة مكاتب في المدينة ولم تعلق الشركة بعد",
    "he": "הפרקליטות פתחה בחקירה נגד החברה בחשד להונאה וערכה חיפוש בכמה משרדים בעיר והחברה טרם הגיבה לדברים",
    "th": "อัยการได้เปิดการสอบสวนบริษัทในข้อหาฉ้อโกงและตรวจค้นสำนักงานหลายแห่งในเมืองบริษัทยังไม่แสดงความเห็น",
    "vi": "Viện kiểm sát đã mở cuộc điều tra đối với công ty vì nghi ngờ gian lận và khám xét một số văn phòng trong thành phố",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(c, t) for c, t in SAMPLES.items()]
    return languages.learn(spark.createDataFrame(rows, "lang string, text string")).cache()


def test_scripts_by_the_other_half_of_a_sample(spark):
    """A model of half of each sample tells the other half of languages that
    have a script or letters of their own.  (Ten words teach too little of the
    others: 13 of all 24 are told.)"""
    def part(t, k):
        return " ".join(t.split()[k::2]) if len(t.split()) > 4 else t[k * len(t) // 2 : (k + 1) * len(t) // 2] + " "

    own = ["ja", "zh", "ko", "ar", "he", "th", "ru", "uk"]
    learned = languages.learn(spark.createDataFrame([(c, part(t, 0)) for c, t in SAMPLES.items()], "lang string, text string"))
    tests = spark.createDataFrame([(c, part(SAMPLES[c], 1) * 2) for c in own], "lang string, text string")
    assert {r["lang"]: r["found"] for r in languages.detect(tests, learned, ("lang",)).collect()} == {c: c for c in own}


@pytest.fixture(scope="module")
def learned_texts(spark, model):
    rows = [(c, (t[len(t) // 3 :] + " ") * 2) for c, t in SAMPLES.items()]
    return {r["lang"]: r["found"] for r in languages.detect(spark.createDataFrame(rows, "lang string, text string"), model, ("lang",)).collect()}


@pytest.mark.parametrize("code", sorted(SAMPLES))
def test_each_language_is_told_from_all_others(learned_texts, code):
    assert learned_texts[code] == code


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = languages.learn(docs.where("doc_id % 5 <> 0"))
    held = docs.where("doc_id % 5 = 0 and char_length(text) >= 50")
    got = languages.detect(held, learned, ("doc_id", "lang")).groupBy("lang").agg(F.avg((F.col("lang") == F.col("found")).cast("int")).alias("right")).collect()
    assert len(got) == 4 and all(r["right"] >= 0.98 for r in got), got


def test_odd_input(spark, model):
    long = "die und der " * 200_000
    rows = [(1, None), (2, ""), (3, "kurz"), (4, "1234567890 " * 20), (5, long), (6, "ab" * 1_000_000), (None, SAMPLES["fr"]), (7, SAMPLES["pl"]), (7, SAMPLES["pl"])]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("x")).withColumn("found", F.lit("y"))
    got = {r["doc_id"]: r["found"] for r in languages.detect(d, model).collect()}
    assert got.pop(6) in SAMPLES
    assert got == {1: "en", 2: "en", 3: "en", 4: "en", 5: "de", None: "fr", 7: "pl"}
    empty = d.where("false")
    assert languages.detect(empty, model).count() == 0 and languages.learn(empty).count() == 0
    assert {r["found"] for r in languages.detect(d, languages.learn(empty)).collect()} == {"en"}


def test_plan_broadcasts_the_model(spark, model):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = languages.detect(d, model)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_runs_fold_where_the_text_lies(spark, model, monkeypatch):
    """A text has a row for each run of the model that it has, not for each place; the
    counts are those of the expressions that the model is learned by."""
    monkeypatch.setattr(languages, "PART", 64)
    texts = [*SAMPLES.values(), "", None, "ab" * 100, "x" * 33 + " y", "é1é" * 20, " a  b ", "𐐀𐐁𐐂 " * 5, ("Wort " * 30 + "z" * 70) * 3]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    grams = [r[0] for r in model.select("gram").distinct().orderBy("gram").collect()] + ["x", " y ", "zzz"]
    rows = d.select("doc_id", languages.known_runs(F.col("text"), grams).alias("r")).select("doc_id", F.inline("r")).groupBy("doc_id", "gram").agg(F.sum("n").alias("n")).collect()
    plain = d.select("doc_id", F.explode(languages.words(F.col("text"))).alias("w")).select("doc_id", F.explode(languages.grams(F.col("w"))).alias("gram"))
    want = plain.where(F.col("gram").isin(grams)).groupBy("doc_id", "gram").agg(F.count("*").alias("n")).collect()
    assert {(r["doc_id"], grams[r["gram"]]): r["n"] for r in rows} == {(r["doc_id"], r["gram"]): r["n"] for r in want}
