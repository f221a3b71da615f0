"""Published examples of the Porter and Snowball algorithms."""

from sparkprep.functions import stems as ST

# Examples given with the published rules.
PORTER = """caresses caress,ponies poni,ties ti,caress caress,cats cat,feed feed,agreed agre,plastered plaster,bled bled,motoring motor,
sing sing,conflated conflat,troubled troubl,sized size,hopping hop,tanned tan,falling fall,hissing hiss,fizzed fizz,failing fail,
filing file,happy happi,sky sky,relational relat,conditional condit,rational ration,valenci valenc,hesitanci hesit,digitizer digit,
conformabli conform,radicalli radic,differentli differ,vileli vile,analogousli analog,vietnamization vietnam,predication predic,
operator oper,feudalism feudal,decisiveness decis,hopefulness hope,callousness callous,formaliti formal,sensitiviti sensit,
sensibiliti sensibl,triplicate triplic,formative form,formalize formal,electriciti electr,electrical electr,hopeful hope,goodness good,
revival reviv,allowance allow,inference infer,airliner airlin,gyroscopic gyroscop,adjustable adjust,defensible defens,irritant irrit,
replacement replac,adjustment adjust,dependent depend,adoption adopt,homologou homolog,communism commun,activate activ,angulariti angular,
homologous homolog,effective effect,bowdlerize bowdler,probate probat,rate rate,cease ceas,controll control,roll roll,is is,toy toi,
syzygy syzygi,generalizations gener,oscillators oscil"""
SNOWBALL = """consign consign,consigned consign,consigning consign,consignment consign,consist consist,consisted consist,consistency consist,
consistent consist,consistently consist,consisting consist,consists consist,consolation consol,consolations consol,consolatory consolatori,
console consol,consolidate consolid,consolingly consol,consonant conson,conspicuous conspicu,conspiracy conspiraci,conspirator conspir,
constable constabl,constancy constanc,constant constant,knack knack,knackeries knackeri,knaves knave,knavish knavish,kneaded knead,
kneel kneel,kneeling kneel,knees knee,knell knell,knelt knelt,knew knew,knick knick,knif knif,knife knife,knight knight,knightly knight,
knights knight,knit knit,knits knit,knitted knit,knitting knit,knives knive,knob knob,knock knock,knocked knock,knocker knocker,
skis ski,skies sky,dying die,news news,inning inning,innings inning,proceed proceed,generously generous,generate generat,generic generic,
communism communism,ties tie,cries cri,gas gas,gaps gap,kiwis kiwi,hoping hope,hopped hop,cry cri,by by,say say,enjoy enjoy,youth youth,
boy's boy,happiness happi,sky sky,bias bias,luxuriated luxuri,fizzed fizz"""


def pairs(text):
    return [tuple(x.split()) for x in text.replace("\n", "").split(",")]


def run(spark, fn, examples):
    df = spark.createDataFrame(examples, "word string, want string")
    return {(r["word"], r["stem"]) for r in fn(df, "word").collect() if r["stem"] != r["want"]}


def test_porter_examples(spark):
    assert run(spark, ST.porter, pairs(PORTER)) == set()


def test_snowball_examples(spark):
    assert run(spark, ST.snowball, pairs(SNOWBALL)) == set()


def test_odd_words(spark):
    df = spark.createDataFrame([("",), (None,), ("A",), ("yyyy",), ("ÉTÉS",), ("x" * 5000 + "ing",), ("Running",), ("''",)], "word string")
    for fn in (ST.porter, ST.snowball):
        got = {r["word"]: r["stem"] for r in fn(df, "word").collect()}
        assert got[None] is None and got[""] == "" and got["A"] == "a" and got["Running"] == "run"
        assert list(fn(df, "word").columns) == ["word", "stem"]
