"""Queries on reads, sequences and probes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence
from ..operators import genome, probes, reads
from ..sources import text
from ..storage import scratch
from .registry import query
from .views import view

#: Short libraries for the pseudo sequences of 96 letters: index, pattern, least start, largest end.
LIBS = [("AAAAAAAAAA", "A{9,}", 0, 80), ("AAAACAAAAA", "(?:AC){2,}", 10, 90), ("AAAAAAAAAC", "A{4,}", 0, 96)]
PAIRED = [("AAAAAAAAAA", 0, 80), ("AAAAAAAAAC", 10, 90), ("CAAAAAAAAA", 0, 60)]
ENZYMES = {"one": "A|CG", "two": "CC|G"}
LIB_ROWS = ", ".join(f"('{n}', '{p}', {a}, {b})" for n, p, a, b in LIBS)
PAIRED_ROWS = ", ".join(f"('{n}', {a}, {b})" for n, a, b in PAIRED)


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_seq")


def as_reads(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    return seqs(spark, sf_dir).select((F.col("doc_id") + shift).alias("read_no"), "seq")


@query("F4 F10 F5 F11", "select doc_id, reverse(translate(seq, 'ATCG', 'TAGC')) as rc, length(seq) - length(replace(seq, 'A', '')) as n_a, repeat(substring(seq, 1, 2), 3) as rep from v_seq")
def sequence_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    return seqs(spark, sf_dir).select("doc_id", sequence.reverse_complement(seq).alias("rc"), sequence.count_of(seq, "A").cast("long").alias("n_a"), F.repeat(F.substring(seq, 1, 2), F.lit(3)).alias("rep"))


@query("F1 F2 F12 F16 P19 D3", """select target, chrom, replace(concat(chrom, ':', t_start), ':', '_') as named, regexp_replace(chrom, '^chr', '') as bare, concat(chrom, ':', t_start, '-', t_end, '_', num_copies, 'xA') as target_id,
 cast(t_end - t_start as integer) as span, case chrom when 'chr1' then 'first' else chrom end as label, 'TGTAAGGCACATCTCGGATC' || 'ACGT' || 'ATCCGACGAGAATCTTGCTTCCCTATAGTGAGTCGTATTA' as probe from v_targets""")
def target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = view(spark, sf_dir, "v_targets").withColumn("target_id", sequence.target_id(F.col("chrom"), F.col("t_start"), F.col("t_end"), F.col("num_copies"), F.lit("A")))
    parts = sequence.parse_target_id(F.col("target_id"))
    return t.select("target", "chrom", F.replace(F.concat("chrom", F.lit(":"), "t_start"), F.lit(":"), F.lit("_")).alias("named"), sequence.without_chr(F.col("chrom")).alias("bare"), "target_id", (parts["end"] - parts["start"]).alias("span"), sequence.mapped(F.col("chrom"), {"chr1": "first"}).alias("label"), sequence.with_adapters(F.lit("ACGT")).alias("probe"))


@query("F6 F3", """with found as (select doc_id, unnest(regexp_extract_all(seq, 'A{6,}|C{6,}|G{6,}|T{6,}')) as run, generate_subscripts(regexp_extract_all(seq, 'A{6,}|C{6,}|G{6,}|T{6,}'), 1) as i, regexp_split_to_array(seq, 'A{6,}|C{6,}|G{6,}|T{6,}') as b, regexp_extract_all(seq, 'A{6,}|C{6,}|G{6,}|T{6,}') as f from v_seq)
 select doc_id, cast(list_sum(list_transform(b[1:i], lambda x: length(x))) + list_sum(list_transform(f[1:i], lambda x: length(x))) - length(run) + 1 as integer) as run_start,
 cast(list_sum(list_transform(b[1:i], lambda x: length(x))) + list_sum(list_transform(f[1:i], lambda x: length(x))) as integer) as run_end, cast(length(run) - 1 as integer) as count, left(run, 1) as letter from found""")
def homopolymer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seqs(spark, sf_dir).select("doc_id", F.inline(sequence.runs(F.col("seq"), 6)))
    return found.select("doc_id", F.col("start").alias("run_start"), F.col("end").alias("run_end"), "count", "letter")


CUTS = "select doc_id, name, cast(list_sum(list_transform(p[1:i], lambda x: length(x))) + (i - 1) * length(site) + cut as integer) as pos from (select doc_id, name, site, cut, string_split(seq, site) as p, unnest(range(1, len(string_split(seq, site)))) as i from v_seq, (values ('one', 'ACG', 1), ('two', 'CCG', 2)) e(name, site, cut))"


@query("F7 D23", CUTS)
def restriction_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, site in ENZYMES.items():
        one = seqs(spark, sf_dir).select("doc_id", F.lit(name).alias("name"), F.explode(sequence.cut_sites(F.col("seq"), site)).alias("pos"))
        out = one if out is None else out.unionByName(one)
    return out


@query("P13 P14", f"""with cut as (select doc_id as read_no, seq as read, substring(seq, 4, 20) as umi, substring(seq, 24, 10) as lib from v_seq),
 found as (select c.*, l.low, l.high, nullif(regexp_extract(read, l.pattern), '') as run from cut c left join (values {LIB_ROWS}) l(lib, pattern, low, high) on l.lib = c.lib)
 select read_no, read, umi, lib, case when strpos(read, run) - 1 >= low and strpos(read, run) - 1 + length(run) <= high then run end as ms from found""")
def single_read_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.extract_single(as_reads(spark, sf_dir), LIBS)


PAIRS_SQL = f"""mates as (select a.doc_id as read_no, a.seq as read_r1, reverse(translate(b.seq, 'ATCG', 'TAGC')) as read_r2 from v_seq a join v_seq b on b.doc_id + 1 = a.doc_id),
 cut as (select *, substring(read_r1, 1, 20) as umi, substring(read_r1, 21, 10) as lib, nullif(regexp_extract(read_r1, 'A{{6,}}'), '') as x1, nullif(regexp_extract(read_r2, 'A{{6,}}'), '') as x2 from mates),
 found as (select read_no, read_r1, read_r2, umi, c.lib, case when strpos(read_r1, x1) - 1 between low and high then x1 end as ms_r1, case when strpos(read_r2, x2) - 1 between low and high then x2 end as ms_r2 from cut c left join (values {PAIRED_ROWS}) l(lib, low, high) on l.lib = c.lib)"""


@query("P15 J15", f"with {PAIRS_SQL} select * from found")
def paired_read_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.extract_paired(as_reads(spark, sf_dir), as_reads(spark, sf_dir, 1), PAIRED)


@query("A28 P16", """with both_ as (select doc_id % 5 as lib, regexp_extract(seq, 'A{3,}') as x, regexp_extract(reverse(seq), 'A{3,}') as y from v_seq)
 select lib, count(*) as n, round(100 * avg(case when length(x) = length(y) then 1 else 0 end), 6) as same_percent from both_ where x <> '' and y <> '' group by 1""")
def run_length_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = seqs(spark, sf_dir).select((F.col("doc_id") % 5).alias("lib"), F.regexp_substr("seq", F.lit("A{3,}")).alias("ms_r1"), F.regexp_substr(F.reverse("seq"), F.lit("A{3,}")).alias("ms_r2"))
    return reads.run_accuracy(one)


@query("S29 P17", """select doc_id, length(seq) as len, strpos(seq, 'AAAAA') - 1 >= 5 and strpos(seq, 'AAAAA') - 1 + 5 <= length(seq) - 5 as good from v_seq""")
def flank_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seqs(spark, sf_dir).select("doc_id", F.char_length("seq").cast("long").alias("len"), probes.good_flanks(F.col("seq"), F.lit(5), F.lit("A")).alias("good"))


SITES = "sites as (select doc_id as chrom, strpos(seq, 'AAAAAAA') - 1 as s, strpos(seq, 'AAAAAAA') + 6 as e, concat('t', doc_id) as target from v_seq where strpos(seq, 'AAAAAAA') > 0)"
MARKS = f"cuts as ({CUTS}), {SITES}, raw as (select doc_id as chrom, pos, case name when 'one' then 0 else 1 end as o, 'RE_' || name as item from cuts union select chrom, s, 2, 'MS_' || target from sites union select chrom, e, 2, 'MS_' || target from sites), marks as (select chrom, cast(pos as integer) as pos, string_agg(item, '|' order by o, item) as item from raw group by 1, 2)"


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    genome = seqs(spark, sf_dir).select(F.col("doc_id").alias("chrom"), "seq")
    start = F.instr("seq", "AAAAAAA") - 1
    sites = seqs(spark, sf_dir).filter(F.instr("seq", "AAAAAAA") > 0).select(F.col("doc_id").alias("chrom"), start.alias("start"), (start + 7).alias("end"), F.concat(F.lit("t"), "doc_id").alias("target"))
    return probes.positions(genome, ENZYMES, sites)


@query("J14", f"with {MARKS} select * from marks")
def position_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marks(spark, sf_dir)


FRAGMENTS = f"""{MARKS}, seen as (select *, coalesce(sum(case when contains(item, 'RE') then 1 else 0 end) over (partition by chrom order by pos rows between unbounded preceding and 1 preceding), 0) as piece from (select *, row_number() over (partition by chrom order by pos desc) as back from marks) where back > 1),
 inside as (select chrom, piece, count(*) as ends, count(distinct item) as names, min(pos) as ms_start, max(pos) as ms_end, min(item) as name from seen where not contains(item, 'RE') group by 1, 2),
 cutted as (select chrom, piece, pos, item, coalesce(lag(pos) over (partition by chrom order by pos), 0) as start, coalesce(lag(item) over (partition by chrom order by pos), 'RE_Start') as l from seen where contains(item, 'RE')),
 frags as (select c.chrom, c.start, c.pos as "end", replace(l, 'RE_', '') as re_left, replace(item, 'RE_', '') as re_right, case when ends = 2 and names = 1 then substring(name, 4) end as target, case when ends = 2 and names = 1 then ms_start end as ms_start, case when ends = 2 and names = 1 then ms_end end as ms_end from cutted c left join inside i on i.chrom = c.chrom and i.piece = c.piece)"""


@query("W8 J14", f"with {FRAGMENTS} select * exclude (ms_start, ms_end) from frags")
def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.fragments(marks(spark, sf_dir)).drop("ms_start", "ms_end")


SIZES = f"""{FRAGMENTS}, sized as (select *, "end" - start as size, case when re_left = re_right then re_left else 'diff' end as side from frags where "end" - start < 2000),
 sizes as (select 'ref_' || side as class, size, count(*) as n from sized group by 1, 2 union all select 'MS_' || side, size, count(*) from sized where target is not null and ms_end - start <= 60 and "end" - ms_start <= 60 group by 1, 2)"""


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.size_classes(probes.fragments(marks(spark, sf_dir)), 60)


@query("A31", f"with {SIZES} select class, size, n from sizes")
def fragment_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sizes(spark, sf_dir)


@query("W5", f"""with {SIZES}, lows as (select unnest(range(min(size), max(size) - 20)) as low from sizes), sums as (select class, low, sum(n) as n from sizes join lows on size >= low and size < low + 20 group by 1, 2)
 select class, cast(low as integer) as low, cast(n as bigint) as n from (select *, row_number() over (partition by class order by n desc, low) as k from sums) where k = 1""")
def best_size_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.best_ranges(sizes(spark, sf_dir), 20)


@query("A32", f"""with {SIZES}, t as (select cast(coalesce(sum(n) filter (class = 'MS_one'), 0) as bigint) as ms, cast(coalesce(sum(n) filter (class = 'ref_one'), 0) as bigint) as ref from sizes) select ms, ref, round(ms / nullif(ms + ref, 0), 6) as enrichment from t""")
def fragment_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.enrichment(sizes(spark, sf_dir), "one")


#: v_seq as three chromosomes; sites of the second enzyme may overlap themselves.
LONG = "long as (select concat('chr', doc_id % 3) as chrom, string_agg(seq, '' order by doc_id) as seq from v_seq group by 1)"
LONG_ENZYMES = {"one": "A|CG", "three": "AC|AAC"}
LONG_CUTS = """{0}, sides as (select chrom, name, site, cut, unnest(string_split(seq, site)) as piece, generate_subscripts(string_split(seq, site), 1) as i from long, (values ('one', 'ACG', 1), ('three', 'ACAAC', 2)) e(name, site, cut)),
 cuts as (select chrom, name, cast(sum(length(piece) + length(site)) over (partition by chrom, name order by i) - length(site) + cut as bigint) as pos from sides qualify i < max(i) over (partition by chrom, name))""".format(LONG)
LONG_MARKS = f"""{LONG_CUTS}, reps as (select chrom, unnest(string_split(seq, 'TTTTTT')) as piece, generate_subscripts(string_split(seq, 'TTTTTT'), 1) as i from long),
 ends as (select chrom, sum(length(piece) + 6) over (partition by chrom order by i) as e from reps qualify i < max(i) over (partition by chrom)),
 raw as (select chrom, pos, case name when 'one' then 0 else 1 end as o, 'RE_' || name as item from cuts union select chrom, e - 6, 2, 'MS_t' || e from ends union select chrom, e, 2, 'MS_t' || e from ends),
 marks as (select chrom, cast(pos as bigint) as pos, string_agg(item, '|' order by o, item) as item from raw group by 1, 2)"""


def long_tiles(spark: SparkSession, sf_dir: str, size: int = 1024) -> DataFrame:
    """Tiles of FASTA files in which each row of v_seq is a line; a line isn't a tile's multiple."""
    chroms = seqs(spark, sf_dir).withColumn("chrom", F.concat(F.lit("chr"), F.col("doc_id") % 3))
    lines = chroms.select("chrom", "doc_id", F.col("seq").alias("value")).unionByName(chroms.select("chrom", F.lit(-1).cast("long").alias("doc_id"), F.concat(F.lit(">"), "chrom").alias("value")).distinct())
    with scratch(spark) as tables:
        path = f"{tables.root}/fasta"
        lines.repartition("chrom").sortWithinPartitions("chrom", "doc_id").select("value").write.text(path)
        return text.fasta_tiles(spark, path, size).checkpoint()


@query("F7 S28", f"with {LONG_CUTS} select chrom, name, pos from cuts")
def genome_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = long_tiles(spark, sf_dir)
    found = [genome.cuts(tiles, site).withColumn("name", F.lit(name)) for name, site in LONG_ENZYMES.items()]
    return found[0].unionByName(found[1])


@query("F6 S28", f"""with {LONG}, found as (select chrom, unnest(regexp_extract_all(seq, 'A+|C+|G+|T+')) as run, generate_subscripts(regexp_extract_all(seq, 'A+|C+|G+|T+'), 1) as i from long),
 ended as (select *, sum(length(run)) over (partition by chrom order by i) as e from found)
 select chrom, cast(e - length(run) + 1 as bigint) as run_start, cast(e as bigint) as run_end, cast(length(run) - 1 as bigint) as count, left(run, 1) as letter from ended where length(run) >= 6""")
def genome_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genome.runs(long_tiles(spark, sf_dir), 6).select("chrom", F.col("start").alias("run_start"), F.col("end").alias("run_end"), "count", "letter")


@query("J14 W8 S28", f"with {FRAGMENTS.replace(MARKS, LONG_MARKS)} select * exclude (ms_start, ms_end) from frags")
def genome_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = long_tiles(spark, sf_dir)
    ends = genome.cuts(tiles, "TTTTTT|")
    sites = ends.select("chrom", (F.col("pos") - 6).alias("start"), F.col("pos").alias("end"), F.concat(F.lit("t"), "pos").alias("target"))
    return probes.fragments(probes.tile_positions(tiles, LONG_ENZYMES, sites), 3000).drop("ms_start", "ms_end")


PROBES = "probes as (select doc_id as probe_no, concat('t', cast(doc_id % 40 as varchar)) as target, case when doc_id % 7 = 0 then 'poor' else 'good' end as code, substring(seq, 1, 12) as seq from v_seq), bad as (select concat('t', cast(i as varchar)) as target from range(0, 40, 9) t(i))"
LISTED = f"{PROBES}, listed as (select target, string_agg('TGTAAGGCACATCTCGGATC' || seq || 'ATCCGACGAGAATCTTGCTTCCCTATAGTGAGTCGTATTA', ',' order by probe_no) as probe_list, count(*) as n_probes from probes where code = 'good' and target not in (select target from bad) group by 1)"


def probe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = seqs(spark, sf_dir).select(F.col("doc_id").alias("probe_no"), F.concat(F.lit("t"), (F.col("doc_id") % 40).cast("string")).alias("target"), F.when(F.col("doc_id") % 7 == 0, "poor").otherwise("good").alias("code"), F.substring("seq", 1, 12).alias("seq"))
    bad = spark.range(0, 40, 9).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("target"))
    return probes.probe_table(rows, bad)


@query("A30 J13 P17 F16 D24", f"with {LISTED} select * from listed")
def probes_by_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe_rows(spark, sf_dir).withColumn("probe_list", F.array_join("probe_list", ","))


@query("A29", f"with {LISTED} select count(distinct target) as targets, cast(coalesce(sum(n_probes), 0) as bigint) as probes, round(sum(n_probes) / count(distinct target), 6) as tile_ratio from listed")
def probe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.probe_counts(probe_rows(spark, sf_dir))


@query("O4 O5", f"with {LISTED}, run as (select target, n_probes, coalesce(sum(n_probes) over (order by md5(concat_ws('|', '1', target)), target rows between unbounded preceding and 1 preceding), 0) as before from listed) select target, n_probes from run where before < 300")
def probes_within_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.within_budget(probe_rows(spark, sf_dir).select("target", "n_probes"), 300)


@query("A37", "with t as (select substring(seq, 1, 6) as s, count(*) as n from v_seq group by 1 having count(*) > 1) select count(*) as values, cast(coalesce(sum(n - 1), 0) as bigint) as surplus from t")
def duplicate_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.stats import duplicates

    return duplicates(seqs(spark, sf_dir).select(F.substring("seq", 1, 6).alias("s")), "s")


@query("P18 P20", "select doc_id from v_seq where length(regexp_extract(seq, 'A{4,}')) between 5 and 8 and substring(seq, strpos(seq, 'AAAA'), 4) = 'AAAA'")
def long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    genome = seqs(spark, sf_dir).select(F.col("doc_id").alias("chrom"), "seq")
    start = F.instr("seq", "AAAA") - 1
    sites = seqs(spark, sf_dir).filter(F.char_length(F.regexp_substr("seq", F.lit("A{4,}"))).between(5, 8)).select(F.col("doc_id").alias("chrom"), start.alias("start"), F.lit(4).alias("copies"), F.lit("A").alias("motif"))
    return probes.on_genome(sites, genome).select(F.col("chrom").alias("doc_id"))
