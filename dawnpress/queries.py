"""Registered queries of the digest engine, and DuckDB SQL for what SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dawnpress.functions import fixed_values as V
from dawnpress.functions import rules
from dawnpress.functions import text as X
from dawnpress.operators import annotations, cluster, edition, events, incremental, lsh, quality, report
from dawnpress.plans.lineage import table_path
from dawnpress.plans.skew import spread
from dawnpress.sources import feeds, store
from dawnpress.streaming import feed_state

#: Event types of the driver's tables as sections.
CATEGORY = {"click": "makro", "view": "global", "purchase": "pasar", "signup": "politik", "error": "makro"}


def articles(spark: SparkSession, d: str) -> DataFrame:
    """Articles over the driver's tables, with their edition: the title is the first line, the summary has the
    stored length."""
    line = F.split("text", "\n")[0]
    docs = spread(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "source", "lang", line.alias("title"), F.substring("text", 1, V.SUMMARY_CHARS).alias("summary")))  # whole texts stay where they are
    ev = spark.read.parquet(f"{d}/events.parquet")
    category = F.create_map(*(F.lit(x) for kv in CATEGORY.items() for x in kv))
    rows = docs.join(ev, docs["doc_id"] == ev["event_id"]).select(
        F.col("doc_id").alias("article_id"), F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string")).alias("url"), F.col("source").alias("domain"),
        "title", "summary", F.col("ts").cast("timestamp_ntz").alias("published_at"),
        category[F.col("event_type")].alias("category"), F.when(F.col("source") == "src0", 2.0).otherwise(1.0).alias("weight"), F.lit(None).cast("string").alias("image"), "lang",
    )
    return edition.with_edition(rows)


def _q(items: list[str]) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def _case(column: str, items: list[str], prefix: bool) -> str:
    whens = " ".join(
        f"when {'starts_with' if prefix else 'ends_with'}({column}, '{s}') and length({column}) - {len(s)} >= {V.STEM_REST} then {f'substr({column}, {len(s) + 1})' if prefix else f'substr({column}, 1, length({column}) - {len(s)})'}" for s in items
    )
    return f"case {whens} else {column} end"


_ART = f"""art as (
  select doc_id article_id, 'https://' || source || '.example/' || doc_id url, source as "domain", string_split(text, chr(10))[1] title, substr(text, 1, {V.SUMMARY_CHARS}) summary, ts published_at,
    case event_type {' '.join(f"when '{k}' then '{v}'" for k, v in CATEGORY.items())} end category, case when source = 'src0' then 2.0::double else 1.0::double end weight, lang,
    cast(ts + interval 2 hour as date) + 1 edition
  from documents join events on event_id = doc_id where ts is not null)"""
_TOK = f"""raw as (select edition, article_id, unnest(regexp_split_to_array(lower(title), '{V.NOT_TOKEN}')) w from art),
s1 as (select edition, article_id, w, {_case('w', V.SUFFIXES, False)} a from raw where length(w) > 2 and w not in ({_q(V.STOP_WORDS)})),
s2 as (select edition, article_id, w, {_case('a', V.PREFIXES, True)} b from s1),
tok as (select distinct edition, article_id, token from (select edition, article_id, case when length(b) < {V.STEM_LEAST} then w else b end token from s2) where token not in ({_q(V.STOP_WORDS)})),
size as (select edition, article_id, count(*) n from tok group by all),
df as (select edition, token, count(*) df from tok group by all),
cut as (select edition, count(*) n_titles, greatest({V.RARE_LEAST}, floor(count(*) * {V.RARE_SHARE}::double))::bigint rare_cut from art group by all)"""
_PAIR = f"""blk as (select edition, article_id, token, n from tok join df using (edition, token) join size using (edition, article_id) where df <= {V.HOT_TOKEN} and n >= {V.LEAST_TOKENS}),
cand as (select distinct x.edition, x.article_id a, y.article_id b from blk x join blk y on x.edition = y.edition and x.token = y.token and x.article_id < y.article_id),
sh as (select c.edition, c.a, c.b, count(*) s, count(*) filter (where d.df <= k.rare_cut) r from cand c join tok x on x.edition = c.edition and x.article_id = c.a join tok y on y.edition = c.edition and y.article_id = c.b and y.token = x.token
       join df d on d.edition = c.edition and d.token = x.token join cut k on k.edition = c.edition group by all),
sim as (select sh.edition, a, b, s::double / (p.n + q.n - s) jaccard, s::double / least(p.n, q.n) overlap, r rare from sh join size p on p.edition = sh.edition and p.article_id = a join size q on q.edition = sh.edition and q.article_id = b),
edge as (select * from sim where jaccard >= {V.THRESHOLD}::double or (rare >= {V.RARE_SHARED} and overlap >= {V.RARE_OVERLAP}::double))"""
#: Without the cut of hot tokens.
_ALL_PAIRS = _PAIR.replace(f"df <= {V.HOT_TOKEN} and ", "")
_COMP = """both_ways as (select a, b from edge union select b, a from edge),
reach as (select article_id a, article_id r from art union select both_ways.b, reach.r from reach join both_ways on both_ways.a = reach.a),
comp as (select a article_id, min(r) event_id from reach group by a)"""
_EVENT = """pop as (select edition, "domain", count(*) popularity from art group by all),
mem as (select art.*, event_id, popularity from art join comp using (article_id) join pop using (edition, "domain")),
rep as (select * from (select *, row_number() over (partition by event_id order by coalesce(summary, '') <> '' desc, length(coalesce(summary, '')) desc, popularity desc, published_at, article_id) k from mem) where k = 1),
cat as (select event_id, category from (select event_id, category, row_number() over (partition by event_id order by count(*) desc, max(published_at) desc, min(article_id)) k from mem group by event_id, category) where k = 1),
agg as (select event_id, count(distinct "domain") n_media, max(weight) weight, count(*) n_articles from mem group by 1),
ev as (select rep.edition, event_id, rep.title, rep.summary, rep.url, rep."domain", rep.published_at, cat.category, n_media, agg.weight, n_articles from rep join cat using (event_id) join agg using (event_id))"""
_TO_EVENT = f"with recursive {_ART}, {_TOK}, {_PAIR}, {_COMP}, {_EVENT}"

#: Headlines for the rule queries: title, summary, domain, n_media, weight.
HEADLINES = [
    ("BI rate naik jadi 6 persen, rupiah menguat", "Bank sentral menaikkan suku bunga acuan", "antara.example", 1, 1.0),
    ("Inflasi melonjak, daya beli turun", None, "kabar.example", 6, 1.0),
    ("Laba bersih emiten sawit tumbuh 12 persen", "Harga CPO naik", "pasar.example", 2, 1.0),
    ("Kapal feri tenggelam, puluhan penumpang hilang", "Basarnas kerahkan tim pencarian", "kabar.example", 2, 1.0),
    ("Tabrakan dua mobil di jalan raya", None, "kabar.example", 1, 1.0),
    ("Menteri resmikan jembatan baru", "Groundbreaking dan seremoni", "kabar.example", 3, 1.0),
    ("Coretax terganggu, wajib pajak mengeluh", "DJP sebut waktu henti", "pajak.example", 1, 1.0),
    ("Restitusi korban dibayar terdakwa", "LPSK mendampingi", "kabar.example", 1, 1.0),
    ("Restitusi ditunda karena penerimaan seret", "Penerimaan pajak turun", "kabar.example", 1, 1.0),
    ("Pemkab gelar pemutihan pajak kendaraan", None, "jepara.kab.go.id", 1, 1.0),
    ("Webinar brevet pajak, segera daftar", None, "pajak.example", 1, 1.0),
    ("OpenAI raises funding for new A.I. chips", "Nvidia supplies GPUs", "tech.example", 1, 1.0),
    ("Gemini dari Google dirilis", "Model baru untuk chatbot", "tech.example", 1, 1.0),
    ("Gemini zodiak hari ini", "Ramalan bintang", "kabar.example", 1, 1.0),
    ("Prompt foto AI yang lagi tren", None, "kabar.example", 1, 1.0),
    ("Kecerdasan buatan ubah lapangan kerja ...", "Karyawan khawatir PHK", "kabar.example", 1, 1.0),
    ("Statement on monetary policy", None, "federalreserve.gov", 1, 2.0),
    ("Governor speech at a dinner", None, "federalreserve.gov", 1, 2.0),
    ("Ekspor tidak turun, surplus dagang bertahan", "Neraca perdagangan surplus", "kabar.example", 1, 1.0),
    ("Pemerintah gagal menaikkan investasi", "Hambatan izin usaha", "kabar.example", 1, 1.0),
    ("Utang bertambah, laba naik", None, "kabar.example", 1, 1.0),
    ("Rekor tertinggi IHSG, net buy asing", "Arus masuk berlanjut", "kabar.example", 5, 1.0),
    ("Kekhawatiran resesi tak hilang", None, "kabar.example", 1, 1.0),
    ("Cuaca cerah di akhir pekan", "", "kabar.example", 1, 1.0),
    ("Penonton konser melonjak", None, "kabar.example", 1, 1.0),
    ("BI menaikkan suku bunga acuan", None, "kabar.example", 1, 1.0),
    ("Kenaikan suku bunga batal, pasar membaik", "Aksi jual mereda", "kabar.example", 1, 1.0),
]


def fixed_headlines(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(HEADLINES)]
    return spark.createDataFrame(rows, "id long, title string, summary string, domain string, n_media int, weight double").withColumn("category", F.lit("politik"))


def headlines(spark: SparkSession, d: str) -> DataFrame:
    """The fixed headlines, and one for each document: its first line before a fixed one, its text behind the
    summary, its own domain for every fifth."""
    fixed = fixed_headlines(spark)
    docs = spread(spark.read.parquet(f"{d}/documents.parquet")).select((F.col("doc_id") + len(HEADLINES)).alias("i"), "text", "source")
    of = F.broadcast(fixed.withColumnRenamed("id", "h"))
    each = docs.join(of, F.pmod("i", F.lit(len(HEADLINES))) == F.col("h")).select(
        F.col("i").alias("id"), F.concat_ws(" ", F.split("text", "\n")[0], "title").alias("title"), F.concat_ws(" ", "summary", "text").alias("summary"),
        F.when(F.col("i") % 5 == 0, F.concat("source", F.lit(".example"))).otherwise(F.col("domain")).alias("domain"), "n_media", "weight", "category",
    )
    return fixed.unionByName(each)


_HEAD = "h(id, title, summary, \"domain\", n_media, weight) as (values " + ", ".join(f"({i}::bigint, " + ", ".join("null" if x is None else "'" + x.replace("'", "''") + "'" for x in r[:3]) + f", {r[3]}, {r[4]}::double)" for i, r in enumerate(HEADLINES)) + ")"
_N = len(HEADLINES)
_HEADS = f"""f{_HEAD[1:]}, h as (select id, title, summary, "domain", n_media, weight from f union all
  select d.doc_id + {_N}, concat_ws(' ', string_split(d.text, chr(10))[1], f.title), concat_ws(' ', f.summary, d.text), case when (d.doc_id + {_N}) % 5 = 0 then d.source || '.example' else f."domain" end, f.n_media, f.weight
  from documents d join f on f.id = (d.doc_id + {_N}) % {_N})"""
_PAD = r"""p as (select *, ' ' || trim(regexp_replace(lower(title), '[^\p{L}\p{N}]+', ' ', 'g')) || ' ' ti, ' ' || trim(regexp_replace(lower(title || ' ' || coalesce(summary, '')), '[^\p{L}\p{N}]+', ' ', 'g')) || ' ' tx from h)"""


def _any(text: str, phrases: list[str]) -> str:
    return f"(len(list_filter([{_q(phrases)}], lambda f: contains({text}, ' ' || f || ' '))) > 0)"


def _first(text: str, groups: dict[str, list[str]]) -> str:
    return "case " + " ".join(f"when {_any(text, p)} then '{k}'" for k, p in groups.items()) + " end"


_WORDS = _any  # a one-word phrase on whole words is a word
_CRASH = f"({_WORDS('tx', V.DISASTER_EVENTS)} and {_WORDS('tx', V.DISASTER_SCALE)})"


def _ends(items: list[str]) -> str:
    return "(" + " or ".join(f"ends_with(\"domain\", '{e}')" for e in items) + ")"


def _marker(markers: list[str], ambiguous: dict[str, list[str]], sign: str) -> str:
    return f"({_any('ti', markers)} or " + " or ".join(f"(contains(ti, ' {k} ') and {sign} {_any('tx', v)})" for k, v in ambiguous.items()) + ")"


_SENTIMENT = f"""with {_HEADS},
part as (select id, 1 part, {V.TITLE_WEIGHT} weight, title t from h union all select id, 2, {V.SUMMARY_WEIGHT}, coalesce(summary, '') from h),
w as (select id, part, weight, list_filter(string_split(trim(regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '), lambda x: x <> '') w from part),
pos as (select *, unnest(range(1, len(w) + 1)) i from w),
ph as (select *, string_split(p, ' ') parts, string_split(p, ' ')[1] head from (select unnest(range(1, {len(V.POSITIVE_PHRASES + V.NEGATIVE_PHRASES)} + 1)) o, unnest([{_q(V.POSITIVE_PHRASES + V.NEGATIVE_PHRASES)}]) p)),
neg as (select *, list_has_any(w[greatest(i - {V.NEGATION_REACH}, 1):i - 1], [{_q(V.NEGATIONS)}]) and i > 1 n1, list_has_any(w[greatest(i - {V.NEGATION_REACH}, 1):i - 1], [{_q(V.NEGATIONS + V.REVERSERS)}]) and i > 1 n2 from pos),
t1 as (select id, part, weight, o, i, p as name, (case when o <= {len(V.POSITIVE_PHRASES)} then 1 else -1 end) * (case when n1 then -1 else 1 end) s from neg join ph on w[i] = head and w[i:i + len(parts) - 1] = parts),
dir as (select *, w[i] in ({_q(V.UP_WORDS)}) up, case when i > 1 then list_reverse(w[greatest(i - {V.LEFT_REACH}, 1):i - 1]) else [] end l, w[i + 1:i + {V.RIGHT_REACH}] r from neg where w[i] in ({_q(V.UP_WORDS + V.DOWN_WORDS)})),
sub as (select *, list_filter(l, lambda x: x in ({_q(V.BAD_SUBJECTS)}))[1] lb, list_filter(l, lambda x: x in ({_q(V.GOOD_SUBJECTS)}))[1] lg, list_filter(r, lambda x: x in ({_q(V.BAD_SUBJECTS)}))[1] rb, list_filter(r, lambda x: x in ({_q(V.GOOD_SUBJECTS)}))[1] rg from dir),
t2 as (select id, part, weight, 1000 o, i, coalesce(lb, lg, rb, rg) || ' ' || w[i] as name, (case when up = (case when lb is not null then false when lg is not null then true when rb is not null then false else true end) then 1 else -1 end) * (case when n2 then -1 else 1 end) s from sub where coalesce(lb, lg, rb, rg) is not null),
t as (select * from t1 union all select * from t2),
g as (select id, sum(s * weight)::int score, arg_min(name, part * 1000000000000 + o * 100000000 + i) first_name from t group by id)
select h.id, case when coalesce(score, 0) > 0 then 'positif' when coalesce(score, 0) < 0 then 'negatif' else 'netral' end as label, coalesce(score, 0)::int score, case when coalesce(score, 0) <> 0 then first_name end as trigger_name from h left join g using (id)"""


# -- queries -------------------------------------------------------------------------------------


def _tokens(s, d):
    return cluster.tokenise(articles(s, d))


def canonical_url(s, d):
    p = s.read.parquet(f"{d}/pages.parquet")
    return p.select("page_id", X.canonical_url("url").alias("canonical"), X.url_id("url").alias("url_id"), X.domain("url").alias("domain"), X.strip_fragment("url").alias("stored_url"), X.slug("url").alias("slug"))


def page_summary_clean(s, d):
    p = s.read.parquet(f"{d}/pages.parquet")
    return p.select("page_id", X.clean_html("html").alias("summary"), X.escape_html("html").alias("escaped"))


def edition_assign(s, d):
    return s.read.parquet(f"{d}/events.parquet").select("event_id", X.edition_date("ts").alias("edition"), X.local_time("ts").alias("local_time"), X.long_date(X.edition_date("ts")).alias("long_date"))


def edition_window(s, d):
    from datetime import date

    return edition.in_window(articles(s, d).drop("edition"), date(2024, 1, 3)).select("article_id", "published_at")


def title_tokens(s, d):
    return _tokens(s, d).select("article_id", F.array_join(F.array_sort("tokens"), " ").alias("tokens"))


def token_df(s, d):
    return cluster.token_frequency(_tokens(s, d)).select(F.col("grp").alias("edition"), "token", "df")


def rare_cut(s, d):
    return cluster.rarity(_tokens(s, d)).select(F.col("grp").alias("edition"), "n_titles", "rare_cut")


def candidate_pairs(s, d):
    t = _tokens(s, d)
    return cluster.candidate_pairs(t, cluster.token_frequency(t)).select(F.col("grp").alias("edition"), "a", "b")


def similar_pairs(s, d):
    return cluster.all_pairs(_tokens(s, d)).select("a", "b", F.round("jaccard", 9).alias("jaccard"), F.round("overlap", 9).alias("overlap"), F.col("rare").cast("long").alias("rare"))


def components(s, d):
    return cluster.clusters(articles(s, d), whole=True)


def incremental_components(s, d):
    """Clusters after the articles came in two batches, each with articles of every edition."""
    a, state = articles(s, d).select("article_id", "title", "edition"), incremental.ClusterState(s, table_path(s, "cluster-state"))
    for k in (0, 1):
        state.update(a.where(F.pmod("article_id", F.lit(2)) == k))
    return state.clusters()


def event_rollup(s, d):
    return events.events_of(articles(s, d)).select("edition", "event_id", "title", "url", "domain", "published_at", "category", "n_media", "weight", "n_articles")


def also_list(s, d):
    return events.events_of(articles(s, d)).select("event_id", F.explode("also").alias("a")).select("event_id", F.col("a.domain").alias("domain"), F.col("a.url").alias("url"))


def domain_popularity(s, d):
    return events.domain_popularity(articles(s, d))


def edition_totals(s, d):
    return edition.totals(articles(s, d))


def edition_sections(s, d):
    """Scored, routed and ranked, without the second clustering of :func:`edition_compose`."""
    shown = edition.compose(articles(s, d), merge=False)
    return shown.select("edition", "section", F.col("rank").cast("long").alias("rank"), "event_id", F.col("impact").cast("long").alias("impact"), "reason", "n_media", "weight", "title")


def edition_compose(s, d):
    return edition.compose(articles(s, d)).select("edition", "section", "rank", "event_id", "impact", "reason", "sentiment", "n_media", "title")


def edition_pages(s, d):
    a = articles(s, d)
    return report.pages(edition.compose(a), edition.totals(a))


def impact_score(s, d):
    return headlines(s, d).withColumn("i", rules.impact()).select("id", F.col("i.impact").cast("long").alias("impact"), "i.reason")


def sentiment_headlines(s, d):
    return headlines(s, d).withColumn("s", rules.direction()).select("id", "s.label", "s.score", F.col("s.trigger").alias("trigger_name"))


def tax_class(s, d):
    return headlines(s, d).withColumn("t", rules.tax_class()).select("id", "t.is_tax", "t.regional", "t.discard", "t.topic")


def ai_class(s, d):
    return headlines(s, d).withColumn("t", rules.ai_class()).select("id", "t.is_ai", "t.discard", "t.topic")


def disaster_flag(s, d):
    h, hits = edition.with_hits(headlines(s, d)), F.col("hits")
    return h.select("id", rules.disaster(hits=hits).alias("disaster"), rules.relevant(hits=hits).alias("relevant"))


def reroute_sections(s, d):
    h = headlines(s, d).withColumn("category", F.element_at(F.array(F.lit("makro"), F.lit("politik"), F.lit("global"), F.lit("pajak"), F.lit("ai"), F.lit("pasar")), (F.col("id") % 6 + 1).cast("int")))
    h = edition.with_hits(h).withColumn("i", rules.impact(hits=F.col("hits")))  # four rules look at each text, which is looked through once
    r = edition.reroute(h.select("id", "title", "domain", "category", "hits", F.col("i.impact").alias("impact"), F.col("i.reason").alias("reason")))
    return r.select("id", "category", F.col("impact").cast("long").alias("impact"), "reason", edition.passes(F.col("hits")).alias("passes"))


_COMMON = ["the", "of", "la", "de", "der", "die", "el", "los"]


def phrase_hits(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", rules.first_label(X.padded("text"), {w: [w] for w in _COMMON}).alias("label"), rules.has_phrase(X.padded("text"), ["of the", "de la", "in the"]).alias("hit"))


def _states(s, d):
    return s.read.parquet(f"{d}/events.parquet").select(F.concat_ws("/", F.concat(F.lit("u"), F.col("user_id").cast("string")), "event_type").alias("url"), F.col("ts").alias("last_success"), F.col("event_id"), "event_type")


def append_ignore(s, d):
    ev = _states(s, d)
    return store.append_ignore(ev.where("event_id % 2 = 0"), ev.where("event_id % 2 <> 0"), "url", F.struct("event_id"))


def upsert_state(s, d):
    ev = _states(s, d)
    old = store.first_per_key(ev.where("event_id % 2 = 0"), "url", F.struct("event_id"))
    new = store.first_per_key(ev.where("event_id % 2 <> 0"), "url", F.struct("event_id"))
    return store.upsert(old, new, "url", "last_success")


def feed_states(s, d):
    """States of feeds after a stream of replies: events as replies of 50 feeds for each of their types."""
    replies = s.readStream.schema("event_id long, ts timestamp, user_id long, event_type string").parquet(f"{d}/[e]vents.parquet").select(  # a pattern: the table may be one file, which a stream does not take by its name
        F.concat_ws("/", "event_type", (F.col("user_id") % 50).cast("string")).alias("url"), F.when(F.col("user_id") % 11 == 0, 500).otherwise(200).alias("status"), F.col("ts").alias("at"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.lit(None).cast("string").alias("body_hash"), (F.col("user_id") % 3).cast("int").alias("n_items"),
    )
    states = feed_state.run_feed_states(replies, table_path(s, "feed-states"), timedelta(hours=4), "1 hour")
    return states.select("url", F.col("at").cast("timestamp_ntz").alias("last_success"), "etag", F.col("last_item").cast("timestamp_ntz").alias("last_item"), "silent")


def title_lsh(s, d):
    """Clusters by the approximate join, beside the exact one of :func:`components`."""
    return lsh.lsh_clusters(_tokens(s, d))


def fill_null(s, d):
    docs = s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("source")).alias("image"))
    found = s.read.parquet(f"{d}/labels.parquet").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("image"), F.col("toxic").alias("o"))
    return store.fill_null(docs, store.last_wins(found, "doc_id", "image", "o"), "doc_id", "image")


def run_metrics(s, d):
    ev = s.read.parquet(f"{d}/events.parquet")
    m = ev.select(F.date_format("ts", "yyyy-MM-dd").alias("run_id"), F.when(F.col("event_type") == "error", "galat").when(F.col("event_type") == "view", "304").otherwise("ok").alias("status"), (F.col("user_id") % 7).cast("int").alias("n_items"), (F.col("user_id") % 3).cast("int").alias("n_new"))
    return feeds.run_summary(m)


def source_status(s, d):
    ev = s.read.parquet(f"{d}/events.parquet")
    m = ev.select(F.concat_ws("/", "event_type", (F.col("user_id") % 50).cast("string")).alias("feed"), F.col("ts").alias("at"), F.when(F.col("event_id") % 5 < 2, "galat").otherwise("ok").alias("status"), (F.col("user_id") % 3).cast("int").alias("n_items"), F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("note"))
    return quality.source_status(m).na.fill(0, ["last_items"])


def article_annotations(s, d):
    """What the rules say of the headlines over documents, with its topics and events."""
    a = annotations.annotate(headlines(s, d), "1", F.lit(None), "id")
    return a.select("article_id", "score", "label", F.array_join("topics", ",").alias("topics"), F.array_join("events", ",").alias("events"))


def _days(s, d):
    return s.read.parquet(f"{d}/events.parquet").where("ts is not null").select(X.edition_date("ts").alias("day")).distinct()


def calendar_grid(s, d):
    return report.calendar_grid(_days(s, d))


def calendar_shortcuts(s, d):
    return report.shortcuts(_days(s, d))


def editions_per_month(s, d):
    return report.editions_per_month(_days(s, d))


def calendar_page(s, d):
    return report.calendar_page(_days(s, d))


def vintage_asof(s, d):
    o = s.read.parquet(f"{d}/orders.parquet").select("o_custkey", "o_orderkey", "o_totalprice", F.struct("o_orderdate", "o_orderkey").alias("k"), F.col("o_orderdate").cast("date").alias("release_date"))
    v = quality.with_validity(o, ["o_custkey"], "k").withColumn("valid_until", F.col("valid_until.o_orderdate").cast("date"))
    return quality.known_on(v, "1997-06-30").select("o_custkey", "o_orderkey", "o_totalprice", "release_date")


def _versions(s, d):
    """Each customer's order as a version of a series, valid until the next one."""
    o = s.read.parquet(f"{d}/orders.parquet").select("o_custkey", "o_orderkey", F.struct("o_orderdate", "o_orderkey").alias("k"), F.col("o_orderdate").cast("date").alias("release_date"))
    return quality.with_validity(o, ["o_custkey"], "k").withColumn("valid_until", F.col("valid_until.o_orderdate").cast("date")).drop("k")


def vintages(s, d):
    """What was known on the first of each month in which something was released."""
    months = s.read.parquet(f"{d}/orders.parquet").select(F.trunc("o_orderdate", "month").alias("day")).distinct()
    return quality.known_at(_versions(s, d), months).select("day", "o_custkey", "o_orderkey", "release_date")


def source_tolerance(s, d):
    """Each month's turnover after orders and after their lines."""
    o = s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.trunc("o_orderdate", "month").alias("month"), "o_totalprice")
    lines = s.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_extendedprice").cast("double") * (1 - F.col("l_discount").cast("double")) * (1 + F.col("l_tax").cast("double"))).alias("v"))
    by_order = o.groupBy("month").agg(F.sum(F.col("o_totalprice").cast("double")).alias("value")).withColumn("source", F.lit("orders"))
    by_line = o.select("o_orderkey", "month").join(lines, "o_orderkey").groupBy("month").agg(F.sum("v").alias("value")).withColumn("source", F.lit("lines"))
    return quality.reconcile(by_order.unionByName(by_line), ["month"], tolerance=0.3).select("month", F.round("middle", 2).alias("middle"), "n_sources", F.round("worst", 6).alias("worst"), F.array_join("off", ",").alias("off"))


def theme_index(s, d):
    """Daily themes of the headlines over documents, each on the day of its event."""
    days = s.read.parquet(f"{d}/events.parquet").select((F.col("event_id") + len(HEADLINES)).alias("id"), F.to_date("ts").alias("day"))
    h = headlines(s, d).withColumn("hits", rules.found()).withColumn("s", rules.direction())
    marked = h.select("id", "domain", F.col("s.score").alias("score"), F.explode(rules.themes(hits=F.col("hits"))).alias("theme")).join(days, "id")
    x = quality.theme_index(marked, days=7, factor=1.0)
    return x.select("day", "theme", "n_articles", "n_sources", F.round("tone", 9).alias("tone"), F.round("agreement", 9).alias("agreement"), "usual", "spread", "spike")


def volume_spikes(s, d):
    c = s.read.parquet(f"{d}/events.parquet").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return quality.volume_spikes(c, ["event_type"], "day", "n", factor=1.2).select("day", "event_type", "n", F.round("usual", 6).alias("usual"))


_FUNCTIONS = (
    canonical_url, page_summary_clean, edition_assign, edition_window, title_tokens, token_df, rare_cut, candidate_pairs, similar_pairs, components, incremental_components, event_rollup, also_list,
    domain_popularity, edition_totals, edition_sections, edition_compose, edition_pages, impact_score, sentiment_headlines, tax_class, ai_class, disaster_flag, reroute_sections, phrase_hits,
    append_ignore, upsert_state, feed_states, title_lsh, fill_null, run_metrics, source_status, article_annotations, calendar_grid, calendar_shortcuts, editions_per_month, calendar_page, vintage_asof, vintages, source_tolerance, theme_index, volume_spikes,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _FUNCTIONS}

_IMPACT = f"""i as (select *, {_first('tx', V.BIG_PHRASES)} big, {_first('tx', V.MEDIUM_PHRASES)} med, {_CRASH} crash, weight >= {V.PRIMARY_WEIGHT} prim,
  {_any('tx', V.DISCARD_PHRASES)} d1, {_any('tx', V.ACCIDENT_PHRASES)} d2 from p),
im as (select *, case when big is null and (d1 or (not crash and d2)) then 0 when big is not null or n_media >= 5 then 3 when crash then 2 when med is not null then 2 when n_media >= 2 or prim then 2 else 1 end::bigint impact,
  case when big is null and (d1 or (not crash and d2)) then null when big is not null then big when n_media >= 5 then 'Liputan luas' when crash then 'Kecelakaan transportasi' when med is not null then med when prim then 'Sumber primer' when n_media >= 2 then 'Liputan meluas' end reason from i)"""
_TAX = f"""tx as (select *, not "domain" in ({_q(V.TAX_FOREIGN)}) and {_marker(V.TAX_MARKERS, V.TAX_AMBIGUOUS, 'not')} is_tax, ({_any('tx', V.TAX_REGIONAL)} or {_ends(V.REGIONAL_DOMAINS)}) regional, {_any('ti', V.TAX_DISCARD)} tax_discard, {_first('tx', V.TAX_TOPICS)} tax_topic0 from p0)"""
_AI = f"""ax as (select *, (regexp_matches(title, '(^|[^A-Za-z])A\\.?I\\.?([^A-Za-z]|$)') or {_marker(V.AI_MARKERS, V.AI_AMBIGUOUS, '')}) is_ai, ({_any('ti', V.AI_DISCARD)} or "domain" in ({_q(V.AI_DISCARD_DOMAINS)}) or {_ends(V.AI_DISCARD_ENDS)} or regexp_matches(title, '(\\.\\.\\.|…)\\s*$')) ai_discard, {_first('tx', V.AI_TOPICS)} ai_topic from p1)"""
_ROUTE = f"""{_TAX},
  p1 as (select * replace (case when m and impact = 1 and not regional then 2 else impact end as impact, case when m and tt is not null and impact <> 3 then tt else reason end as reason), case when m then 'pajak' else cat0 end cat1
         from (select *, cat0 = 'pajak' or (is_tax and cat0 in ('makro', 'politik')) m, case when regional then 'Pajak daerah' else tax_topic0 end tt from tx)), {_AI},
  r as (select *, cat1 = 'ai' or (cat1 in ('makro', 'politik', 'global') and is_ai) am from ax),
  r2 as (select *, am and impact = 3 and coalesce(reason, '') = 'Liputan luas' demoted from r),
  r3 as (select *, case when demoted then 2 else impact end::bigint imp, case when demoted then 'Liputan meluas' else reason end rea, case when am then 'ai' else cat1 end cat2 from r2),
  routed as (select *, case when am and ai_topic is not null and imp <> 3 then ai_topic else rea end rea2,
    (case when "domain" in ({_q(V.CENTRAL_BANKS)}) then {_any('ti', V.CENTRAL_BANK_WORDS)} when cat2 = 'politik' then ({_any('tx', V.POLITICS_WORDS)} or crash) else true end)
    and imp <> 0 and not (m and tax_discard) and not (am and (ai_discard or not is_ai)) passes from r3)"""
_SECTION_LIMIT = "case category " + " ".join(f"when '{k}' then {v}" for k, v in V.SECTION_LIMITS.items()) + " end"
_DAYS = "days as (select distinct cast(ts + interval 2 hour as date) + 1 \"day\" from events where ts is not null)"
_MONTH_NAMES = "[" + _q(V.MONTHS) + "]"
_STATES = "st as (select 'u' || user_id || '/' || event_type url, ts last_success, event_id, event_type from events)"

#: The entities that the tables hold; ``&amp;`` last.
_UNESCAPED = "p"
for _name, _char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", "\u00a0"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    _UNESCAPED = f"regexp_replace({_UNESCAPED}, '&{_name};?', '{_char}', 'g')"

ORACLES: dict[str, str] = {
    "canonical_url": f"""with b as (select page_id, url, split_part(url, '#', 1) bare from pages),
        q as (select *, split_part(bare, '?', 1) base, list_filter(string_split(case when contains(bare, '?') then substr(bare, length(split_part(bare, '?', 1)) + 2) else '' end, '&'), lambda x: x <> '' and {' and '.join(f"not starts_with(lower(x), '{p}')" for p in V.DROPPED_PARAMS)}) kept from b),
        c as (select *, case when len(kept) > 0 then base || '?' || array_to_string(kept, '&') else base end canonical from q)
        select page_id, canonical, sha256(canonical) url_id, regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1), '^www\\.', '') as "domain", bare stored_url,
        coalesce(nullif(regexp_replace(regexp_replace(lower(url), '[^\\p{{L}}\\p{{N}}\\-_]', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'tanpa-nama') slug from c""",
    "page_summary_clean": f"""with e as (select page_id, html, regexp_replace(html, '<[^>]+>', ' ', 'g') p from pages),
        u as (select page_id, html, {_UNESCAPED} t from e), c as (select page_id, html, regexp_replace(regexp_replace(t, '[\\s\\p{{Z}}\\x{{85}}\\x0b]+', ' ', 'g'), '^ | $', '', 'g') t from u)
        select page_id, case when t <> '' then substr(t, 1, {V.SUMMARY_CHARS}) end summary, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') escaped from c""",
    "edition_assign": f"""with e as (select event_id, ts, cast(ts + interval 2 hour as date) + 1 edition from events) select event_id, edition, coalesce(strftime(ts + interval 7 hour, '%H:%M'), '—') local_time,
        [{_q(V.DAYS)}][isodow(edition)] || ', ' || day(edition) || ' ' || {_MONTH_NAMES}[month(edition)] || ' ' || year(edition) long_date from e""",
    "edition_window": f"with {_ART} select article_id, published_at from art where published_at >= timestamp '2024-01-01 22:00:00' and published_at < timestamp '2024-01-02 22:00:00'",
    "title_tokens": f"with {_ART}, {_TOK} select a.article_id, coalesce(string_agg(token, ' ' order by token), '') tokens from art a left join tok t using (article_id) group by a.article_id",
    "token_df": f"with {_ART}, {_TOK} select edition, token, df from df",
    "rare_cut": f"with {_ART}, {_TOK} select edition, n_titles, rare_cut from cut",
    "candidate_pairs": f"with {_ART}, {_TOK}, {_PAIR} select edition, a, b from cand",
    "similar_pairs": f"with {_ART}, {_TOK}, {_ALL_PAIRS} select a, b, round(jaccard, 9) jaccard, round(overlap, 9) overlap, rare from edge",
    "components": f"with recursive {_ART}, {_TOK}, {_ALL_PAIRS}, {_COMP} select article_id, event_id from comp",
    "incremental_components": f"with recursive {_ART}, {_TOK}, {_PAIR}, {_COMP} select article_id, event_id from comp",
    "event_rollup": f"{_TO_EVENT} select edition, event_id, title, url, \"domain\", published_at, category, n_media, weight, n_articles from ev",
    "also_list": f"{_TO_EVENT}, l as (select event_id, \"domain\" dom, url, row_number() over (partition by event_id, \"domain\" order by published_at desc, article_id) k from mem) select l.event_id, l.dom as \"domain\", l.url from l join ev on ev.event_id = l.event_id where k = 1 and l.dom <> ev.\"domain\"",
    "domain_popularity": f"with {_ART} select edition, \"domain\", count(*) popularity from art group by all",
    "edition_totals": f"with {_ART} select edition, count(distinct \"domain\") n_sources, count(*) n_articles from art group by all",
    "edition_sections": f"""{_TO_EVENT.replace(_PAIR, _ALL_PAIRS)}, h as (select event_id id, edition, title, summary, "domain", published_at, n_media, weight, category cat_in from ev), {_PAD}, {_IMPACT}, p0 as (select *, cat_in cat0 from im), {_ROUTE},
        ok as (select id event_id, edition, title, published_at, n_media, weight, cat2 category, imp impact, rea2 reason, coalesce(m and regional, false) late, (m and tt is null) or (not m and am and ai_topic is null) topicless from routed where passes),
        top as (select *, row_number() over (partition by edition order by late, impact desc, n_media * weight desc, topicless, published_at desc, event_id) "rank" from ok where impact = 3 qualify "rank" <= {V.TOP_LIMIT}),
        rest as (select *, row_number() over (partition by edition, category order by late, impact desc, n_media * weight desc, topicless, published_at desc, event_id) "rank" from ok
          where event_id not in (select event_id from top) and category in ({_q(list(V.SECTION_LIMITS))}) qualify "rank" <= {_SECTION_LIMIT})
        select edition, '{V.TOP_SECTION}' as "section", "rank", event_id, impact, reason, n_media, weight, title from top union all select edition, category, "rank", event_id, impact, reason, n_media, weight, title from rest""",
    "impact_score": f"with {_HEADS}, {_PAD}, {_IMPACT} select id, impact, reason from im",
    "sentiment_headlines": _SENTIMENT,
    "tax_class": f"with {_HEADS}, {_PAD}, p0 as (from p), {_TAX} select id, is_tax, regional, tax_discard as discard, case when regional then 'Pajak daerah' else tax_topic0 end topic from tx",
    "ai_class": f"with {_HEADS}, {_PAD}, p1 as (from p), {_AI} select id, is_ai, ai_discard as discard, ai_topic topic from ax",
    "disaster_flag": f"with {_HEADS}, {_PAD} select id, {_CRASH} disaster, case when \"domain\" in ({_q(V.CENTRAL_BANKS)}) then {_any('ti', V.CENTRAL_BANK_WORDS)} else ({_any('tx', V.POLITICS_WORDS)} or {_CRASH}) end relevant from p",
    "reroute_sections": f"""with {_HEADS}, {_PAD}, {_IMPACT}, p0 as (select *, ['makro', 'politik', 'global', 'pajak', 'ai', 'pasar'][id % 6 + 1] cat0 from im), {_ROUTE}
        select id, cat2 category, imp impact, rea2 reason, passes from routed""",
    "phrase_hits": "with p as (select doc_id, ' ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ' t from documents) select doc_id, case " + " ".join(f"when contains(t, ' {w} ') then '{w}'" for w in _COMMON) + " end as label, contains(t, ' of the ') or contains(t, ' de la ') or contains(t, ' in the ') hit from p",
    "append_ignore": f"with {_STATES}, n as (select *, row_number() over (partition by url order by event_id) k from st where event_id % 2 <> 0) select url, last_success, event_id, event_type from n where k = 1 and url not in (select url from st where event_id % 2 = 0)",
    "upsert_state": f"with {_STATES}, n as (select *, event_id % 2 g, row_number() over (partition by url, event_id % 2 order by event_id) k from st), u as (select *, row_number() over (partition by url order by g desc, last_success desc) j from n where k = 1) select url, last_success, event_id, event_type from u where j = 1",
    "feed_states": """with r as (select event_type || '/' || (user_id % 50) url, user_id % 11 <> 0 good, ts, 'e' || event_id etag, user_id % 3 n from events where ts is not null),
        f as (select url, max(ts) last_success, max({'t': ts, 'e': etag}) m, max(ts) filter (where n > 0) last_item from r where good group by url)
        select url, last_success, m.e etag, last_item, coalesce(last_item + interval 4 hour <= (select max(ts) from r) - interval 1 hour, false) silent from f""",
    "fill_null": "with f as (select doc_id, arg_max('q' || quality, toxic) image from labels group by 1) select d.doc_id, coalesce(case when d.doc_id % 3 = 0 then source end, f.image) image from documents d left join f using (doc_id)",
    "run_metrics": "select strftime(ts, '%Y-%m-%d') run_id, count(*) checked, count(*) filter (where event_type = 'view') unchanged, count(*) filter (where event_type = 'error') failed, sum(user_id % 7)::bigint items, sum(user_id % 3)::bigint as \"new\", bool_and(event_type = 'error') all_failed from events group by 1",
    "calendar_grid": f"""with {_DAYS}, m as (select distinct date_trunc('month', "day")::date "month" from days),
        c as (select "month", unnest(generate_series("month" - (isodow("month") - 1)::int, last_day("month") + (7 - isodow(last_day("month")))::int, interval 1 day))::date "day" from m)
        select "month", c."day", (datediff('day', "month" - (isodow("month") - 1)::int, c."day") // 7)::int as "week", (isodow(c."day") - 1)::int as "weekday",
        case when date_trunc('month', c."day")::date <> "month" then 'blank' when d."day" is null then 'none' when c."day" = (select max("day") from days) then 'newest' else 'edition' end as "state" from c left join days d on d."day" = c."day" """,
    "calendar_shortcuts": f"with {_DAYS}, o(days_back, label) as (values {', '.join(f'({n}, {chr(39)}{t}{chr(39)})' for n, t in V.SHORTCUTS)}) select days_back::int days_back, label, (select max(\"day\") from days) - days_back::int as \"day\" from o where (select max(\"day\") from days) - days_back::int in (select \"day\" from days)",
    "editions_per_month": f"with {_DAYS} select date_trunc('month', \"day\")::date as \"month\", count(*) n_editions, min(\"day\") first_day, max(\"day\") last_day from days group by 1",
    "vintage_asof": "with v as (select o_custkey, o_orderkey, o_totalprice, o_orderdate::date release_date, lead(o_orderdate::date) over (partition by o_custkey order by o_orderdate, o_orderkey) u from orders) select o_custkey, o_orderkey, o_totalprice, release_date from v where release_date <= date '1997-06-30' and (u is null or u > date '1997-06-30')",
    "vintages": """with v as (select o_custkey, o_orderkey, o_orderdate::date release_date, lead(o_orderdate::date) over (partition by o_custkey order by o_orderdate, o_orderkey) u from orders),
        m as (select distinct date_trunc('month', o_orderdate)::date "day" from orders)
        select "day", o_custkey, o_orderkey, release_date from m join v on release_date <= "day" and (u is null or u > "day")""",
    "source_tolerance": """with o as (select o_orderkey, date_trunc('month', o_orderdate)::date "month", o_totalprice::double p from orders),
        v as (select "month", 'orders' src, sum(p) v from o group by 1 union all
          select "month", 'lines', sum(l_extendedprice::double * (1 - l_discount::double) * (1 + l_tax::double)) from o join lineitem on l_orderkey = o_orderkey group by 1),
        m as (select "month", median(v) middle, count(*) n_sources from v group by 1)
        select "month", round(middle, 2) middle, n_sources, round(max(abs(v - middle) / middle), 6) worst, coalesce(string_agg(case when abs(v - middle) / middle > 0.3 then src end, ',' order by src), '') "off"
        from m join v using ("month") group by all""",
    "source_status": """with m as (select event_type || '/' || (user_id % 50) feed, ts w, event_id % 5 >= 2 good, user_id % 3 n, 'n' || event_id note from events where ts is not null),
        l as (select *, max(case when good then w end) over (partition by feed) last_good from m)
        select feed, count(*) n_runs, max(w) last_run, any_value(last_good) last_good, count(*) filter (where last_good is null or w > last_good) n_failed, coalesce(arg_max(n, w) filter (where n > 0), 0)::int last_items, arg_max(note, w) note,
          case when any_value(last_good) is null or count(*) filter (where w > last_good) >= 3 then 'down' when count(*) filter (where w > last_good) > 0 then 'warn' else 'ok' end "level" from l group by feed""",
    "article_annotations": _SENTIMENT.replace("select h.id, case", f""", sent as (select h.id, coalesce(score, 0) score, ' ' || trim(regexp_replace(lower(h.title || ' ' || coalesce(h.summary, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' ' tx from h left join g using (id))
        select id article_id, score::double score, case when score > 0 then 'positif' when score < 0 then 'negatif' else 'netral' end "label",
        array_to_string(list_filter([{', '.join(f"case when {_any('tx', p)} then '{k}' end" for k, p in (V.BIG_PHRASES | V.MEDIUM_PHRASES).items())}], lambda x: x is not null), ',') topics,
        case when {_CRASH} then 'disaster' else '' end events from sent --""").split(" --")[0],
    "theme_index": _SENTIMENT.replace("select h.id, case", f""", sent as (select h.id, coalesce(score, 0) score, h."domain", ' ' || trim(regexp_replace(lower(h.title || ' ' || coalesce(h.summary, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' ' tx from h left join g using (id)),
        th as (select id, score, "domain", unnest(list_filter([{', '.join(f"case when {_any('tx', p)} then '{k}' end" for k, p in (V.BIG_PHRASES | V.MEDIUM_PHRASES).items())}], lambda x: x is not null)) theme from sent),
        e as (select ts::date "day", theme, "domain", count(*) n, sum(score) s from th join events on event_id + {_N} = id group by all),
        dd as (select "day", theme, sum(n)::bigint n_articles, count(*) n_sources, sum(s)::double / sum(n) tone, greatest(count(*) filter (where s > 0), count(*) filter (where s < 0), count(*) filter (where s = 0))::double / count(*) agreement from e group by all),
        ww as (select *, median(n_articles) over k usual, mad(n_articles) over k spread from dd window k as (partition by theme order by "day" rows between 7 preceding and 1 preceding))
        select "day", theme, n_articles, n_sources, round(tone, 9) tone, round(agreement, 9) agreement, usual::double usual, spread::double spread, coalesce(n_articles - usual > 1.0::double * 1.4826::double * spread and n_articles - usual >= 1, false) spike from ww --""").split(" --")[0],
    "volume_spikes": "with c as (select ts::date as \"day\", event_type, count(*) n from events group by all), w as (select *, avg(n) over (partition by event_type order by \"day\" rows between 7 preceding and 1 preceding) usual from c) select \"day\", event_type, n, round(usual, 6) usual from w where n > 1.2::double * usual",
}
