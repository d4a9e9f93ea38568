"""Documents made ready for training: language, near-duplicates, benchmark leaks, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetworks.llm import decontaminate, language, packing, simhash, surrogates
from fleetworks.llm.frames import hidden, shown
from fleetworks.session import settle

#: Replace it by a secret of your own; whoever has it can test guesses against surrogates.
SURROGATE_KEY = b"set a secret key here"

#: A document with this score stays in any case. Below it, one stays that scores as labelled documents of its language do.
SURE_SCORE = 0.5

#: Learned, bound to nothing but texts and labels, and needed by nobody else.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, learned from the labelled ones, takes for one of the languages it knows.

    The score has to be ``SURE_SCORE``, or what all but 0.2 % of the labelled documents of that prediction reach; the more
    languages, the lower that is. A sample only gives the network to start from: it then learns from all labelled documents,
    whole, and all of them have a say in what is usual. Repeated rows are treated alike. If no language could be learned,
    all documents with a letter stay. An empty table gives an empty result.
    """
    different = language.different_rows(docs)
    network = language.learn_all(docs, language.fit(docs, different=different), different=different)
    inside, names = hidden(docs)
    if not network.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    scored = settle(language.identify(inside, network, names["text"]), "language-scores")
    usual = language.usual_scores(scored, network, names["doc_id"], names["text"], names["lang"])
    # a language that no labelled document was taken for has no usual score, and nothing to judge by
    least = {lang: min(SURE_SCORE, usual.get(lang, 0.0)) for lang in network.languages}
    wanted = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.col("lang_pred")]
    return shown(scored.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= wanted)), names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the SimHash operator links, by its own shingles and bits: the smallest id, null last.

    Null and empty texts are one group. Of repeated rows any one stays. An empty table gives an empty result.
    """
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts have no words and stay; of repeated rows all stay or none. An empty table, or one without
    benchmark words, changes nothing.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets.

    Null and empty texts stay as they are; equal texts get equal surrogates. An empty table gives an empty result.
    """
    inside, names = hidden(docs)
    return shown(surrogates.anonymize(inside, SURROGATE_KEY, names["text"]), names)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each a sequence of its own, with their token ids.

    Null and empty texts make one piece of the end id; repeated rows have pieces of their own. An empty table gives none.
    """
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
