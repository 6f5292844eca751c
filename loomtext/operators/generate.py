"""Row generators: documents to instruction, question, completion, reasoning and chat rows.

Templates are small tables of our own wording; a document and a template set meet in an array that is exploded, so
no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.lexicons import PHASES

from .chunk import chunks_every

EOT = "<|eot_id|>"
SYSTEMS = {
    "legal_specialist": "You are a UK legal specialist who gives accurate, well-supported analysis.",
    "tax_specialist": "You are a UK tax adviser who gives accurate, compliant guidance.",
}


def _c(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _rows(*rows: dict[str, Column]) -> Column:
    return F.array(*[F.struct(*[v.alias(k) for k, v in r.items()]) for r in rows])


def instructions(docs: DataFrame, *, long_text: int = 2048) -> DataFrame:
    """id, title, type, year, text in; five rows each, and one for each chunk of texts over ``long_text``."""
    t, text, kind, year = F.col("title"), F.col("text"), F.col("type"), F.col("year").cast("string")
    fixed = _rows(
        {"instruction": _c("What is ", t, "?"), "output": _c(t, " is a ", kind, " from ", year, ". It reads:\n\n", text)},
        {"instruction": _c("Explain the content of ", t), "output": text},
        {"instruction": _c("What does document ", F.col("id").cast("string"), " contain?"), "output": _c("Document ", F.col("id").cast("string"), ", titled '", t, "', contains:\n\n", text)},
        {"instruction": _c("What type of document is ", t, "?"), "output": _c(t, " is a ", kind, " of ", year, ".")},
        {"instruction": _c("When was ", t, " made?"), "output": _c(t, " was made in ", year, ".")},
    )
    keep = ["id", "type", "year"]
    base = docs.select(*keep, F.explode(fixed).alias("r")).select(*keep, "r.*", F.lit(None).cast("int").alias("section"))
    parts = docs.where(F.length("text") > long_text).select(*keep, "title", F.posexplode(chunks_every(text)).alias("i", "c"))
    chunked = parts.select(*keep, _c("Give section ", (F.col("i") + 1).cast("string"), " of ", t).alias("instruction"), F.col("c")["text"].alias("output"), (F.col("i") + 1).alias("section"))
    return base.unionByName(chunked).withColumn("input", F.lit(""))


def completions(docs: DataFrame, *, size: int = 8192, overlap: int = 400) -> DataFrame:
    return docs.select("id", "type", "year", F.explode(chunks_every(F.col("text"), size, overlap)).alias("c")).select("id", "type", "year", F.col("c")["text"].alias("text"))


def question_answers(docs: DataFrame) -> DataFrame:
    """Three rows each, and one for each of the first five paragraphs of more than 100 characters."""
    t, text = F.col("title"), F.col("text")
    context = F.when(F.length(text) > 500, _c(F.substring(text, 1, 500), "...")).otherwise(text)
    fixed = _rows(
        {"question": _c("What is ", t, "?"), "answer": _c(t, " is a ", F.col("type"), " from ", F.col("year").cast("string"), ".")},
        {"question": _c("What is the purpose of ", t, "?"), "answer": _c(F.substring(text, 1, 500))},
        {"question": _c("Where does ", t, " come from?"), "answer": _c("It is document ", F.col("id").cast("string"), ".")},
    )
    base = docs.select("id", context.alias("context"), F.explode(fixed).alias("r")).select("id", "context", "r.*", F.lit(None).cast("int").alias("section"))
    parts = docs.select("id", "title", context.alias("context"), F.posexplode(F.slice(F.split(text, "\n\n"), 1, 5)).alias("i", "p")).where(F.length(F.trim("p")) > 100)
    more = parts.select("id", "context", _c("What does paragraph ", (F.col("i") + 1).cast("string"), " of ", t, " say?").alias("question"), F.trim("p").alias("answer"), (F.col("i") + 1).alias("section"))
    return base.unionByName(more)


#: (level, complexity, instruction before the title, excerpt length)
LEVELS = (
    ("foundation", "basic", ("Summarise the main points of ", "What is the scope of ", "Who is affected by "), 300),
    ("reasoning", "intermediate", ("Reason step by step about ",), 400),
    ("expert", "advanced", ("Advise a client in depth on ",), 500),
    ("adversarial", "adversarial", ("Argue against the position in ",), 400),
)


def training_examples(docs: DataFrame) -> DataFrame:
    """doc_id, title, content in; (doc_id, level, complexity, instruction, output, text): 3 + 1 + 1 + 1 rows each."""
    rows = [
        {"level": F.lit(level), "complexity": F.lit(c), "instruction": _c(i, F.col("title")), "output": _c(F.col("title"), ": ", F.substring("content", 1, n))}
        for level, c, starts, n in LEVELS
        for i in starts
    ]
    out = docs.select("doc_id", F.explode(_rows(*rows)).alias("r")).select("doc_id", "r.*")
    return out.withColumn("text", _c(F.col("instruction"), "\n\n", F.col("output"), EOT))


REASONING_KINDS = {
    "issue": ("Identify the issues in {t}", "List the facts that matter in {t}"),
    "rule": ("State the rules applied in {t}", "Explain the authority relied on in {t}"),
    "application": ("Apply the rules of {t} to its facts", "Show how the reasoning of {t} proceeds"),
    "conclusion": ("Give the outcome of {t}", "Explain the effect of {t}"),
    "comparison": ("Compare {t} with earlier authority", "Distinguish {t} from a contrary case"),
}
#: Opening and objection, one for each counter-argument row.
COUNTER_PAIRS = (
    ("Answer the objection to {t} that ", "the facts differ"),
    ("How would the losing side of {t} argue that ", "the authority is weak"),
    ("Defend {t} against the charge that ", "the remedy is out of proportion"),
    ("On appeal from {t} it is said that ", "the public interest points elsewhere"),
)
PRACTICE_STARTS = ("How would a practitioner use ", "What should a client do in light of ")
MULTI_STEP_STARTS = ("Work through the stages of ", "Set out, in order, what follows from ")
ADVERSARIAL_STARTS = ("Make the strongest case against ", "Find the weakest point of ")


def _from_starts(docs: DataFrame, kind: str, starts: tuple[str, ...], *, excerpt: int = 200, least: int = 100) -> DataFrame:
    short = F.when(F.length("content") > excerpt, _c(F.substring("content", 1, excerpt), "...")).otherwise(F.col("content"))
    rows = [{"kind": F.lit(kind), "question": _c(s, F.col("title"), "? ", short)} for s in starts]
    return docs.where(F.length("content") >= least).select("doc_id", F.explode(_rows(*rows)).alias("r")).select("doc_id", "r.*")


def multi_step(docs: DataFrame) -> DataFrame:
    return _from_starts(docs, "multi_step", MULTI_STEP_STARTS)


def adversarial(docs: DataFrame) -> DataFrame:
    return _from_starts(docs, "adversarial", ADVERSARIAL_STARTS)


def practical(docs: DataFrame) -> DataFrame:
    return _from_starts(docs, "practical", PRACTICE_STARTS)


def advanced(legal: DataFrame, tax: DataFrame) -> DataFrame:
    """Questions on legal and tax documents; only legal ones have another side to argue."""
    both = legal.unionByName(tax)
    return multi_step(both).unionByName(adversarial(legal)).unionByName(practical(both))


def enhanced(cases: DataFrame) -> DataFrame:
    """(doc_id, mode, kind, question): reasoning and counter-argument rows of cases."""
    one = reasoning_rows(cases).select("doc_id", F.lit("reasoning").alias("mode"), "kind", "question")
    return one.unionByName(counter_rows(cases).select("doc_id", F.lit("counter").alias("mode"), F.col("argument").alias("kind"), "question"))


def reasoning_rows(docs: DataFrame) -> DataFrame:
    """Ten rows each: five kinds by two templates."""
    rows = [
        {"kind": F.lit(kind), "question": _c(a.split("{t}")[0], F.col("title"), a.split("{t}")[1])} for kind, both in REASONING_KINDS.items() for a in both
    ]
    return docs.select("doc_id", F.explode(_rows(*rows)).alias("r")).select("doc_id", "r.*")


def counter_rows(docs: DataFrame) -> DataFrame:
    """Four rows each: the first opening with the first argument, and so on."""
    rows = [{"argument": F.lit(a), "question": _c(o.split("{t}")[0], F.col("title"), o.split("{t}")[1], a)} for o, a in COUNTER_PAIRS]
    return docs.select("doc_id", F.explode(_rows(*rows)).alias("r")).select("doc_id", "r.*")


def chat_text(system: Column, instruction: Column, response: Column) -> Column:
    head = lambda role: f"<|start_header_id|>{role}<|end_header_id|>\n\n"
    return _c("<|begin_of_text|>", head("system"), system, EOT, head("user"), instruction, EOT, head("assistant"), response, EOT)


def chat_rows(rows: DataFrame, specialist: str, phase: str) -> DataFrame:
    """instruction, input, output, complexity in; chat rows of a phase: long answers cut, other complexities left out."""
    longest, wanted = {p: (n, c) for p, n, c in PHASES}[phase]
    asked = F.when(F.coalesce(F.col("input"), F.lit("")) != "", _c(F.col("instruction"), "\n\nContext: ", F.col("input"))).otherwise(F.col("instruction"))
    answer = F.when(F.length("output") > longest, _c(F.substring("output", 1, longest), "...")).otherwise(F.col("output"))
    level = F.coalesce("complexity", F.lit("basic"))
    kept = rows.withColumn("complexity", level) if wanted == "basic" else rows.withColumn("complexity", level).where(F.col("complexity") == wanted)
    out = kept.withColumn("response", answer).withColumn("instruction", asked)
    out = out.withColumn("text", chat_text(F.lit(SYSTEMS[specialist]), F.col("instruction"), F.col("response")))
    return out.select("text", "instruction", "response", F.lit(specialist).alias("specialist_type"), F.lit(phase).alias("training_phase"), "complexity", F.length("text").alias("length"))


def content_rows(docs: DataFrame, specialist: str) -> DataFrame:
    """doc_id, title, content in; instruction (one of four, by hash) and a response of context and details."""
    starts = (
        ("Explain the principles in '", "Analyse the requirements of '", "What follows for practitioners from '", "Sum up the essentials of '")
        if specialist == "legal_specialist"
        else ("Explain the tax rules in '", "What must be complied with under '", "Analyse the planning in '", "Sum up the guidance in '")
    )
    parts = F.split("content", "\n\n")
    context = F.when(F.size(parts) > 1, F.get(parts, 0)).otherwise(F.substring("content", 1, 500))
    details = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 2, 2), "\n\n")).otherwise(F.substring("content", 501, 1000))
    pick = F.get(F.array(*[F.lit(s) for s in starts]), F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)).cast("int"))
    response = _c("On '", F.col("title"), "':\n\n", context, "\n\n", details)
    return docs.where(F.length("content") >= 100).select("doc_id", _c(pick, F.col("title"), "'").alias("instruction"), F.lit("").alias("input"), response.alias("output"), F.lit("basic").alias("complexity"))


INCOMES = ((35_000, 2_000), (75_000, 10_000), (150_000, 20_000))
TURNOVERS = ((90_000, 0.20), (250_000, 0.20))
PROFITS = (80_000, 400_000)


def tax_calculations(spark) -> DataFrame:
    """kind, question, answer: three income, two VAT and two corporation rows."""
    income = spark.createDataFrame([("income_tax", i, p) for i, p in INCOMES], "kind string, a long, b long")
    base = F.greatest(F.lit(0), F.col("a") - F.col("b") - 12570)
    number = lambda c: F.format_number(c, 0)
    one = income.select(
        "kind", _c("Income of £", number(F.col("a")), " with pension payments of £", number(F.col("b")), ": what is taxable?").alias("question"),
        _c("Taxable income is £", number(base), ".").alias("answer"),
    )
    vat = spark.createDataFrame([("vat", t, r) for t, r in TURNOVERS], "kind string, a long, b double")
    two = vat.select("kind", _c("Turnover of £", number(F.col("a")), " at a rate of ", F.col("b").cast("string"), "%: what is due?").alias("question"), _c("Apply the rate to turnover of £", number(F.col("a")), ".").alias("answer"))
    corp = spark.createDataFrame([("corporation_tax", p) for p in PROFITS], "kind string, a long")
    three = corp.select("kind", _c("Profits of £", number(F.col("a")), ": how are they taxed?").alias("question"), _c("Apply the rate for profits of £", number(F.col("a")), ".").alias("answer"))
    return one.unionByName(two).unionByName(three)


def numbered_authorities(authorities: Column) -> Column:
    """Text of array<struct<citation, title, level, text>>: numbered, texts cut at 300."""
    one = lambda a, i: F.concat_ws(
        "\n", _c((i + 1).cast("string"), ". ", F.coalesce(a["citation"], a["title"], F.lit("Untitled"))), F.when(a["level"].isNotNull(), _c("Level: ", a["level"].cast("string"))), F.substring(a["text"], 1, 300)
    )
    return F.array_join(F.transform(authorities, one), "\n\n")


def authority_bands(hits: DataFrame) -> DataFrame:
    """Hits with a confidence band and their text cut at 500."""
    s = F.col("score")
    return hits.withColumn("confidence", F.when(s > 0.8, "high").when(s > 0.6, "medium").otherwise("low")).withColumn("text", F.substring("text", 1, 500))


def query_context(area: Column, jurisdiction: Column, client: Column) -> Column:
    line = lambda label, c: F.when(c.isNotNull(), _c(label, c))
    return F.coalesce(F.nullif(F.concat_ws("\n", line("Area: ", area), line("Jurisdiction: ", jurisdiction), line("Client: ", client)), F.lit("")), F.lit("General question"))


REASONING_STEPS = {
    "legal_analysis": ("Identify the issue", "Find the governing law", "Set out the authorities", "Apply the law to the facts", "Weigh the counter-arguments", "Note uncertainty", "Conclude"),
    "tax_analysis": ("Identify the taxes", "Find the legislation", "Check the guidance", "Compute the effect", "Look for reliefs", "Check compliance duties", "Conclude"),
    "litigation_analysis": ("Identify the claims", "Check procedure", "Assess evidence", "Set out the authorities", "Estimate prospects", "Consider settlement", "Conclude"),
}


def reasoning_chain(kind: Column, jurisdiction: Column) -> Column:
    """Seven steps; the jurisdiction is named where there is one."""
    steps = None
    for name, texts in REASONING_STEPS.items():
        value = F.array(*[F.lit(t) for t in texts])
        steps = F.when(kind == name, value) if steps is None else steps.when(kind == name, value)
    steps = steps.otherwise(F.array(*[F.lit(t) for t in REASONING_STEPS["legal_analysis"]]))
    return F.transform(steps, lambda s, i: F.when(jurisdiction.isNotNull() & (i == 1), F.concat(s, F.lit(" in "), jurisdiction)).otherwise(s))


TAX_PROFILES = (("a company director", 60_000, 40_000),)
OPTIMISATION_STARTS = (
    "How should salary and dividends be balanced for ", "Which pension payments suit ", "How can gains be timed by ",
    "Which allowances are open to ", "What can a spouse's allowances add for ", "Which reliefs for investment suit ",
)
COMPLIANCE_STARTS = (
    "Which returns are due from ", "Which records must be kept by ", "Which deadlines bind ", "Which penalties threaten ", "How can errors be put right by ",
)


def tax_planning(spark) -> DataFrame:
    """kind, question: six rows on optimisation and five on compliance for each profile."""
    profiles = spark.createDataFrame(list(TAX_PROFILES), "who string, salary long, dividends long")
    who = _c(F.col("who"), " with a salary of £", F.format_number("salary", 0), " and dividends of £", F.format_number("dividends", 0), "?")
    rows = [{"kind": F.lit("optimisation"), "question": _c(s, who)} for s in OPTIMISATION_STARTS] + [{"kind": F.lit("compliance"), "question": _c(s, who)} for s in COMPLIANCE_STARTS]
    return profiles.select(F.explode(_rows(*rows)).alias("r")).select("r.*")


def tax_scenarios(spark) -> DataFrame:
    """All 18 rows: kind, question."""
    return tax_calculations(spark).select("kind", "question").unionByName(tax_planning(spark))


def all_phases(rows: DataFrame, *, domains: dict[str, list[str]], key: str) -> DataFrame:
    """Chat rows of both specialists and all phases, with ``split`` (80 / 20 by hash) within each.

    ``rows`` has domain and a unique key besides the columns of ``chat_rows``; a specialist takes its domains' rows.
    """
    from .chunk import hash_split

    out = None
    for specialist, own in domains.items():
        for phase, _, _ in PHASES:
            one = chat_rows(rows.where(F.col("domain").isin(*own)), specialist, phase)
            out = one if out is None else out.unionByName(one)
    return hash_split(out.withColumn(key, F.sha2("text", 256)), key, by=["specialist_type", "training_phase"], test_share=0.2).drop(key)


def alternatives(query: Column, authorities: Column) -> Column:
    """At most three other views worth stating."""
    low = F.lower(query)
    return F.slice(
        F.array_compact(
            F.array(
                F.when(F.size(authorities) > 1, "The authorities may be read differently"),
                F.when(F.contains(low, F.lit("contract")), "The claim may lie in tort as well"),
                F.when(F.contains(low, F.lit("tax")), "Another tax treatment may apply"),
                F.lit("Settlement may serve better than a decision"),
            )
        ),
        1,
        3,
    )


def procedural_points(query: Column, area: Column) -> Column:
    """At most five steps of procedure to check."""
    low = F.lower(query)
    return F.slice(
        F.array_compact(
            F.array(
                F.lit("Check time limits"),
                F.when(F.contains(low, F.lit("court")), "Check the court's rules"),
                F.when(F.contains(low, F.lit("appeal")), "Check whether leave is needed"),
                F.when(area == "tax", "Check the review and appeal route"),
                F.when(area == "employment", "Check early conciliation"),
                F.when(area == "housing", "Check notice requirements"),
            )
        ),
        1,
        5,
    )


def model_questions(sections: DataFrame, fn, *, title: str = "title", text: str = "text") -> DataFrame:
    """Question and answer rows that an injected model writes for each section; answers that do not parse give none."""
    from .extract import call_model, json_rows

    asked = sections.withColumn("prompt", _c("Write question and answer pairs as a JSON list on ", F.col(title), ":\n\n", F.substring(F.col(text), 1, 50_000)))
    answered = call_model(asked, "prompt", fn)
    pairs = answered.withColumn("qa", F.explode(json_rows(F.col("response"), "struct<question:string,answer:string>")))
    return pairs.select(*sections.columns, F.col("qa")["question"].alias("question"), F.col("qa")["answer"].alias("answer"))
