"""Product rules: safety by tiers, publishing, listening, scripts. Where the rules are prose, the reading is ours
and is said so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Phrases, cues and their tags, length targets.
DIDACTIC = ["今天告诉我们", "所以我们要", "小朋友应该"]
FISH_TAGS = {"笑": "[laughs]", "叹气": "[sigh]", "兴奋": "[excited]", "惊讶": "[surprised]", "轻声": "[whisper]"}
NATIVE_TAGS = {"笑": "(laughs)", "惊呼": "(gasps)", "叹气": "(sighs)", "吸气": "(inhale)"}
CUE_EMOTIONS = {"开心": "happy", "紧张": "fearful", "平静": "calm", "温和": "calm"}
PROSODY = ["压低", "轻声", "慢", "快", "喊"]
TIMBRE = ["更低沉", "更明亮", "浑厚", "清脆", "柔和", "有力"]
LENGTHS = {"primary": (2000, 2500), "junior": (3000, 3700)}
FATHER = "爸爸"
#: The qualitative table as admission and strength of the hint; "almost none" reads as none. Our reading.
SENSITIVE = [
    ("conservative", "primary", "none", "none"), ("conservative", "junior", "rare", "normal"), ("standard", "primary", "limited", "normal"),
    ("standard", "junior", "normal", "normal"), ("open", "primary", "limited", "weak"), ("open", "junior", "normal", "weak"),
]
ADMISSIONS = ["none", "rare", "limited", "normal"]


def safety_matrix(spark: SparkSession) -> DataFrame:
    """parent_tier, age_tier, safety, admit, hint for all 18 combinations; redlines never pass, defaults always."""
    rows = [(p, a, s, *(("none", "none") if s == "redline" else ("normal", "none") if s == "default" else (admit, hint))) for p, a, admit, hint in SENSITIVE for s in ("redline", "sensitive", "default")]
    return spark.createDataFrame(rows, "parent_tier string, age_tier string, safety string, admit string, hint string")


def decide(items: DataFrame, matrix: DataFrame) -> DataFrame:
    """items (safety, parent_tier, age_tier) with admit, hint, heavy and review. A missing parent tier is
    standard; an unknown tier of safety goes to a human."""
    own = items.withColumns({"parent_tier": F.coalesce("parent_tier", F.lit("standard"))})
    out = own.join(matrix, ["parent_tier", "age_tier", "safety"], "left")
    return out.withColumns({"review": F.col("admit").isNull(), "admit": F.coalesce("admit", F.lit("none")), "hint": F.coalesce("hint", F.lit("none"))}).withColumn("heavy", (F.col("safety") == "sensitive") & (F.col("admit") != "none"))


def age_tier(grade: Column, nudge: Column | None = None) -> Column:
    """primary up to grade 6, junior from 7 on; a nudge moves one step at most and stays within the tiers."""
    step = F.when(grade <= 6, 0).when(grade >= 7, 1)
    moved = step + F.greatest(F.lit(-1), F.least(F.lit(1), F.coalesce(nudge, F.lit(0)))) if nudge is not None else step
    at = F.greatest(F.lit(0), F.least(F.lit(1), moved))
    return F.when(step.isNull(), F.lit(None)).when(at == 0, "primary").otherwise("junior")


def publish(episodes: DataFrame, modes: DataFrame, vetoes: DataFrame) -> DataFrame:
    """episodes (family_id, episode_id) with release: published, or held until it is reviewed where the family
    wants that. What was vetoed is dropped. Families without a mode publish."""
    kept = episodes.join(vetoes, ["family_id", "episode_id"], "left_anti").join(modes, "family_id", "left")
    return kept.withColumn("release", F.when(F.col("mode") == "review_first", "held").otherwise("published"))


def with_evergreen(days: DataFrame, picks: DataFrame, evergreen: DataFrame) -> DataFrame:
    """days (day) with topic and origin: the pick of the day, else the evergreen script of the day's turn.
    evergreen (turn, topic) counts turns from 0 and is of the default tier."""
    n = evergreen.agg(F.count("*").alias("n"))
    turned = days.withColumn("k", F.lit(1)).join(n.withColumn("k", F.lit(1)), "k").drop("k")  # n is one row
    own = turned.withColumn("turn", F.pmod(F.datediff("day", F.lit("1970-01-01").cast("date")), F.col("n")))
    return own.join(picks.withColumnRenamed("topic", "picked"), "day", "left").join(evergreen, "turn", "left").select("day", F.coalesce("picked", "topic").alias("topic"), F.when(F.col("picked").isNull(), "evergreen").otherwise("picked").alias("origin"))


def completion(listens: DataFrame, by: list[str], finished: Column) -> DataFrame:
    """Started and finished listens, and their ratio."""
    return listens.groupBy(*by).agg(F.count("*").alias("started"), F.count_if(finished).alias("finished")).withColumn("rate", F.col("finished") / F.col("started"))


def days_of(listens: DataFrame) -> DataFrame:
    """user_id, day: each day on which a user listened, once."""
    return listens.select("user_id", F.to_date("ts").alias("day")).distinct()


def streaks(days: DataFrame) -> DataFrame:
    """Runs of consecutive days: user_id, first_day, last_day, days."""
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("day"))
    return days.withColumn("run", F.date_sub("day", at)).groupBy("user_id", "run").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days")).drop("run")


def next_day_return(days: DataFrame) -> DataFrame:
    """day, listeners, returned: of those who listened, who did so the next day too."""
    after = F.lead("day").over(Window.partitionBy("user_id").orderBy("day"))
    return days.withColumn("back", F.coalesce(F.datediff(after, "day") == 1, F.lit(False))).groupBy("day").agg(F.count("*").alias("listeners"), F.count_if("back").alias("returned")).withColumn("rate", F.col("returned") / F.col("listeners"))


def signal_digest(signals: DataFrame) -> DataFrame:
    """Signals (ts, kind) by week, from Monday, and kind."""
    return signals.groupBy(F.to_date(F.date_trunc("week", "ts")).alias("week"), "kind").agg(F.count("*").alias("n"))


def script_lines(scripts: DataFrame) -> DataFrame:
    """Lines spoken in the body of Markdown scripts (path, value): path, line_no, speaker, text. The body is the
    section ## 正文 up to the next heading of its level; emphasis and cues are cut."""
    body = F.regexp_extract("value", r"(?s)(?:^|\n)##\s*正文[^\n]*\n(.*?)(?=\n##\s|\z)", 1)
    rows = scripts.select("path", F.posexplode(F.split(body, r"\r?\n")).alias("line_no", "line"))
    spoken = r"^\s*(?:\*\*)?([^*：:\s]+)(?:\*\*)?\s*[：:]\s*(?:\*\*)?\s*(.*)$"
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("line", spoken, 2), r"\*\*|__", ""), r"（[^）]*）|\([^)]*\)", ""))
    return rows.where(F.col("line").rlike(spoken)).select("path", (F.col("line_no") + 1).alias("line_no"), F.regexp_extract("line", spoken, 1).alias("speaker"), text.alias("text"))


def lint(lines: DataFrame, by: list[str], age: Column, father: str = FATHER) -> DataFrame:
    """A row for each script: characters against the target of its age tier, didactic lines, and whether the
    father asks more than he concludes (questions against other sentences)."""
    questions, ends = F.regexp_count("text", F.lit("[？?]")), F.regexp_count("text", F.lit("[。！!.]"))
    dad = F.col("speaker") == father
    out = lines.groupBy(*by).agg(
        F.sum(F.length("text")).alias("chars"), F.count_if(F.col("text").rlike("|".join(DIDACTIC))).alias("didactic"),
        F.sum(F.when(dad, questions).otherwise(0)).alias("questions"), F.sum(F.when(dad, ends).otherwise(0)).alias("conclusions"),
    )
    low = F.when(age == "primary", LENGTHS["primary"][0]).otherwise(LENGTHS["junior"][0])
    high = F.when(age == "primary", LENGTHS["primary"][1]).otherwise(LENGTHS["junior"][1])
    return out.withColumns({"length_ok": F.col("chars").between(low, high), "asks_more": F.col("questions") > F.col("conclusions")})


def _replaced(text: Column, values: dict[str, str]) -> Column:
    for cue, tag in values.items():
        text = F.replace(text, F.lit(f"（{cue}）"), F.lit(tag))
    return text


def fish_text(text: Column) -> Column:
    """Cues as inline tags."""
    return _replaced(text, FISH_TAGS)


def native_text(text: Column) -> Column:
    """Cues as native sounds; a marked paragraph is a newline; all other cues leave the text."""
    kept = _replaced(F.replace(text, F.lit("<换段>"), F.lit("\n")), NATIVE_TAGS)
    return F.regexp_replace(kept, "（[^）]*）", "")


def cue_settings(text: Column) -> Column:
    """What cues set: emotion (the first that names one), prosody and timbre words, voice and sound effect."""
    cues = F.regexp_extract_all(text, F.lit("（([^）]*)）"), F.lit(1))
    emotion = F.when(F.lit(False), F.lit(""))
    named = F.filter(cues, lambda c: c.isin(*CUE_EMOTIONS))
    first = F.try_element_at(named, F.lit(1))
    for cue, value in CUE_EMOTIONS.items():
        emotion = emotion.when(first == cue, value)
    value = lambda key: F.nullif(F.regexp_extract(text, f"（{key}=([^）]+)）", 1), F.lit(""))
    return F.struct(emotion.alias("emotion"), F.filter(cues, lambda c: c.isin(*PROSODY)).alias("prosody"), F.filter(cues, lambda c: c.isin(*TIMBRE)).alias("timbre"), value("音色").alias("voice"), value("音效").alias("effect"))


def spoken_forms(text: Column, entries: dict[str, str]) -> Column:
    """text with dictionary entries in their spoken form, the longest first."""
    for written in sorted(entries, key=lambda w: (-len(w), w)):
        text = F.replace(text, F.lit(written), F.lit(entries[written]))
    return text


def recommend(candidates: DataFrame, families: DataFrame, history: DataFrame, n: int = 3, weight: int = 5, most: int = 4) -> DataFrame:
    """family, topic, score, place: the n best topics for each of families (family, tier), of candidates (topic, tier, base) for
    its tier. Each time that its history (family, topic) has the topic adds `weight` to the base score, up to `most` times: interest
    never lowers a score, so a topic that a family hasn't had can only be among its best where it is among the n best of the tier.
    So a family is held against its own topics and those n alone. Of equal scores the first topic in order is better. A
    candidate without topic, tier or base is none, and a family without a tier has none.
    """
    known = candidates.where("topic IS NOT NULL AND tier IS NOT NULL AND base IS NOT NULL").groupBy("topic", "tier").agg(F.max("base").alias("base"))
    who = families.where("family IS NOT NULL AND tier IS NOT NULL").select("family", "tier").distinct()
    best = F.row_number().over(Window.partitionBy("tier").orderBy(F.desc("base"), "topic"))
    general = known.withColumn("place", best).where(F.col("place") <= n).groupBy("tier").agg(F.collect_list(F.struct("topic", F.col("base").alias("score"))).alias("x"))
    had = history.groupBy("family", "topic").agg(F.count("*").alias("times"))
    own = had.join(who, "family").join(known, ["topic", "tier"]).select("family", "topic", (F.col("base") + weight * F.least("times", F.lit(most))).alias("score"))
    new = who.join(general, "tier").select("family", F.inline("x"))
    scores = own.unionByName(new).groupBy("family", "topic").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("family").orderBy(F.desc("score"), "topic"))
    return scores.withColumn("place", place).where(F.col("place") <= n)
