"""One query per operator, each over its whole table, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import round_trip
from tidemark.llm.chat import CALL, MESSAGE, RESULT, format_chats
from tidemark.llm.decontaminate import contamination
from tidemark.llm.hyperminhash import near_copies
from tidemark.llm.jaccard import link_documents
from tidemark.llm.language import held_out, identify, learn
from tidemark.llm.prefixes import node_digests, prefix_trie, turn_steps
from tidemark.llm.quality import judge_quality
from tidemark.llm.secrets import scan_secrets
from tidemark.llm.shards import kd_shards
from tidemark.llm.shared import workspace
from tidemark.llm.tokens import read_checksums, starts, write_tokens
from tidemark.llm.urls import judge_urls
from tidemark.llm.vector_codes import compress_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The vocabulary file; its place is where the installed package of public tokenizers has it.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@query
def op1_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with workspace(spark) as work:
        return contamination(docs, table(spark, sf_dir, "benchmark"), work).checkpoint()


@query
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    model = learn(docs.filter(~F.col("held_out")).select(F.col("doc_id").alias("id"), "lang", "text"))
    return identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query
def op3_ngram_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with workspace(spark) as work:
        linked = link_documents(docs, work, size=3, percent=90)
        return linked.drop("_id", "first").checkpoint()


SHARDS = 40


@query
def op4_kd_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        "source",
        "lang",
        "n_chars",
    )
    with workspace(spark) as work:
        placed = kd_shards(rows, "size", ["n_chars", "source", "lang", "doc_id"], SHARDS, work)
        return placed.select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        ).checkpoint()


@query
def op5_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, vocabulary())


# The rules that the contract states.
URL_RULES = """
    VALUES ('org', '/', 'allow'),
           ('example.org', '/es/', 'block'),
           ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'),
           ('com', '/de/', 'block') AS t(host, path, action)
"""


@query
def op6_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, spark.sql(f"SELECT * FROM {URL_RULES}")).drop("url")


@query
def op7_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with workspace(spark) as work:
        return scan_secrets(docs, work).checkpoint()


@query
def op8_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with workspace(spark) as work:
        path = f"{work.path}/tokens"
        write_tokens(docs, path, vocabulary(), work)
        sums = read_checksums(spark, path).join(starts(spark, path), ["part", "pack"])
        return sums.select(
            "doc_id", (F.col("pack_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
        ).checkpoint()


# The tool that conversations are taken to call: a user's turn is a call whose result is the
# next turn, if that is the assistant's. A call needs the result of the user's turn before it.
REPLY = {
    "type": "object",
    "required": ["text", "turn"],
    "additionalProperties": False,
    "properties": {
        "text": {"type": "string", "minLength": 1, "maxLength": 1000},
        "turn": {"type": ["integer", "null"], "minimum": 0},
    },
}
# Results of these turns of every four arrive late, after the call that needs them; in one of so
# many conversations, arguments are plain text and no JSON.
LATE, PLAIN = (1, 2), 7


@query
def op9_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    kind = F.when(user, F.lit(CALL)).when(assistant, F.lit(RESULT)).otherwise(F.lit(MESSAGE))

    def identifier(turn):
        return F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    called = F.when(assistant, F.col("turn") - 1).otherwise(F.col("turn"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.max(F.when(user, F.col("turn"))).over(before)
    arguments = F.to_json(F.struct("text", "turn"), {"ignoreNullFields": "false"})
    arguments = F.when(F.col("conv_id") % PLAIN == 3, F.col("text")).otherwise(arguments)
    late = F.when(assistant & (F.col("turn") % 4).isin(*LATE), F.lit(5)).otherwise(F.lit(0))
    events = turns.select(
        "conv_id", "role", "text",
        F.col("turn").alias("spoken"),
        (F.col("turn") * 2 + late).alias("turn"),
        kind.alias("kind"),
        F.when(user | assistant, identifier(called)).alias("call_id"),
        F.when(user, F.lit("reply")).alias("name"),
        F.when(user, arguments).alias("arguments"),
        F.when(user & earlier.isNotNull(), F.array(identifier(earlier))).alias("needs"),
    )
    with workspace(spark) as work:
        formatted = format_chats(events, {"reply": REPLY}, work)
        return formatted.select(
            "conv_id", F.col("spoken").alias("turn"), "kind", "seq", "call_id", "linked",
            F.size("errors").alias("n_errors"), "json",
        ).checkpoint()


@query
def op10_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs).drop("text", "clean_text")


# Fixed values of the contract: conversations are rebuilt from the first turns of every hundredth
# one, at most five of them.
EVERY, LEADS = 100, 6


def rebuilt(steps: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of another one (see EVERY), and go on with
    their own turns after as many."""
    conv, pos = F.col("conv"), F.col("pos")
    lead = F.pmod(F.crc32(F.encode(conv.cast("string"), "UTF-8")), F.lit(LEADS))
    base = conv - conv % EVERY
    firsts = steps.filter((pos < LEADS - 1) & (conv == base))
    convs = steps.select("conv").distinct().select("conv", lead.alias("lead"), base.alias("base"))
    heads = convs.join(firsts.withColumnRenamed("conv", "base"), "base").filter(pos < F.col("lead"))
    had = firsts.groupBy("conv").agg(F.count(F.lit(1)).alias("had")).withColumnRenamed("conv", "base")
    tails = steps.withColumns({"lead": lead, "base": base}).filter(pos >= F.col("lead"))
    taken = F.least("lead", F.coalesce("had", F.lit(0)))
    tails = tails.join(had, "base", "left").withColumn("pos", pos - F.col("lead") + taken)
    return heads.select(steps.columns).unionByName(tails.select(steps.columns))


@query
def op11_prefix_trie(spark, sf_dir):
    with workspace(spark) as work:
        steps = work.write(turn_steps(table(spark, sf_dir, "conversations"), work), "steps")
        turns = work.write(rebuilt(steps), "rebuilt")
        return node_digests(prefix_trie(turns, steps.select("conv"), work)).checkpoint()


@query
def op12_vector_codes(spark, sf_dir):
    with workspace(spark) as work:
        codes = compress_vectors(table(spark, sf_dir, "embeddings"), work)
        rows = codes.rows.select("vec_id", "code", "error", "label_error")
        return rows.withColumn("codebooks_sha256", F.lit(codes.digest())).checkpoint()


@query
def op13_hyperminhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with workspace(spark) as work:
        linked = near_copies(docs, work, size=2, percent=80)
        return linked.select("doc_id", "n_shingles", "component_id", "kept").checkpoint()
