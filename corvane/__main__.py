"""Command line: ``python -m corvane COMMAND --help``. Paths can be any that Spark reads."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import vector as V
from .functions.text import PROMPTS, SEARCH_PROMPTS, word_count
from .operators import clustered, collection, compare, embed, merge, profile, quality, reconcile, sampling, search
from .session import session
from .sources import papers as papers_source
from .sources import hdf5, pubmed, sinks, stores
from .streaming import incremental


def _embedder(a):
    if a.api == "hash":
        return lambda: embed.HashEmbedder(a.dim)
    return lambda: embed.HttpEmbedder(a.url, a.model, a.api)


def _show(df: DataFrame, out: str | None) -> None:
    if out:
        df.write.mode("overwrite").json(out)
    else:
        df.show(200, truncate=80)


def do_profile(spark: SparkSession, a) -> None:
    lines = spark.read.text(a.input)
    if a.sample:
        lines = profile.sample_lines(lines, a.sample)
    _show(profile.completeness(lines, a.required.split(",")), a.out)
    _show(profile.valid_rate(lines, a.required.split(",")), None)
    if a.filtered:
        sinks.write_lines(profile.complete_lines(lines, a.required.split(",")), a.filtered, "value")


def do_lengths(spark: SparkSession, a) -> None:
    rows = papers_source.read_papers(spark, a.input).select("id", "row_index", "title", "abstract", word_count(F.col("abstract")).alias("n"))
    for df in (profile.length_stats(rows, "n"), profile.length_percentiles(rows, "n"), profile.length_histogram(rows, "n"), profile.longest(rows, "n", "row_index", "id", "title"), profile.processable(rows, "n", a.model_max)):
        _show(df, None)
    if a.summary:
        sinks.write_lines(profile.summary_text(rows, "n", "row_index", "abstract", a.model_max).orderBy("line").coalesce(1), a.summary, "value")


def do_embed(spark: SparkSession, a) -> None:
    if a.stream:
        incremental.embed_stream(incremental.paper_stream(spark, a.input), a.out, f"{a.out}.failed", f"{a.out}.checkpoint", _embedder(a), a.concurrency).awaitTermination()
        return
    rows = papers_source.read_papers(spark, a.input, a.start, a.limit)
    run = uuid.uuid4().hex
    with stores.appending(spark, a.out, run) as start:
        counts = embed.write_results(embed.embed_papers(rows, _embedder(a), a.concurrency), f"{a.out}.results/{run}")
        results = spark.read.parquet(f"{a.out}.results/{run}")
        sinks.append_vectors(stores.with_positions(embed.succeeded(results), "row_index", start=start), a.out)
        embed.failures(results).write.mode("append").json(f"{a.out}.failed")
    sinks.write_json(sinks.run_info(counts, a.model or a.api, a.dim, a.prompt), f"{a.out}.info")
    gone = spark._jvm.org.apache.hadoop.fs.Path(f"{a.out}.results/{run}")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def _hits(corpus: DataFrame, a, text: str) -> DataFrame:
    if a.paper_id:
        return search.similar_to(corpus, a.paper_id, a.top_k, "title" if a.side == "title" else "abstract")
    q = _embedder(a)()(PROMPTS[a.prompt or SEARCH_PROMPTS[a.side if a.side in SEARCH_PROMPTS else "combined"]] + text)
    if a.side == "combined":
        return (search.search_candidates if a.candidates else search.search_combined)(corpus, q, a.top_k)
    if a.side == "mean":
        return search.search_mean(corpus, q, a.top_k)
    return search.search(corpus, q, a.top_k, a.side, a.metric, a.threshold)


def do_search(spark: SparkSession, a) -> None:
    if a.parts:  # numbered NPZ parts of both sides
        corpus = stores.zip_parts(stores.read_npz(spark, *a.parts[0].split(",")), stores.read_npz(spark, *a.parts[1].split(",")))
    else:
        corpus = stores.read_store(spark, a.vectors)
    metadata = papers_source.load_metadata(spark, a.metadata) if a.metadata else None

    def answer(text: str, out: str | None) -> None:
        hits = _hits(corpus, a, text)
        _show((search.with_metadata(hits, metadata) if a.metadata else hits).orderBy("rank"), out)

    if not a.interactive:
        return answer(a.query, a.out)
    corpus = search.prepare(corpus).persist()  # held, with norms, for all questions
    metadata = metadata.persist() if a.metadata else None
    print("A question a line; an empty line ends.")
    for line in iter(lambda: input("> ").strip(), ""):
        answer(line, None)
    corpus.unpersist()


def do_merge(spark: SparkSession, a) -> None:
    shards = [stores.read_store(spark, p) for p in a.inputs]
    if faults := merge.incompatibilities(shards):
        raise SystemExit("\n".join(faults))
    merged = merge.merge(shards, remove_duplicates=not a.keep_duplicates).persist()
    order = F.col("shard") * (1 << 40) + F.col("row_index")
    stores.with_positions(merged, order).drop("shard").write.mode("errorifexists").parquet(a.out)
    merged.unpersist()
    sinks.write_json(merge.manifest(shards, a.inputs, merge.assert_equal_lengths(spark.read.parquet(a.out))), f"{a.out}.manifest")


def do_failed(spark: SparkSession, a) -> None:
    rows = papers_source.read_papers(spark, a.input)
    source, stored = papers_source.valid_ids(spark, a.input), stores.read_store(spark, a.vectors).select("paper_id")
    _show(reconcile.id_diff(source, stored), None)
    failed = reconcile.missing_ids(source, stored)
    if a.logs:
        failed = reconcile.all_failed(failed, stores.failed_ids(stores.read_logs(spark, a.logs)))
    sinks.write_ids(failed, f"{a.out}/ids")
    sinks.write_json(reconcile.retry_input(rows, failed), f"{a.out}/retry")


def do_stats(spark: SparkSession, a) -> None:
    v = stores.read_store(spark, a.vectors)
    _show(stores.store_structure(v), None)
    _show(quality.integrity(v), None)
    for side in quality.SIDES:
        _show(quality.matrix_stats(v, side), None)
        _show(quality.dimension_ranges(quality.dimension_stats(v, side)), None)
    _show(quality.pair_stats(v), None)
    if a.export:
        sinks.export_sample(v, a.export)


def do_audit(spark: SparkSession, a) -> None:
    v = stores.read_store(spark, a.vectors)
    some = sampling.sample(v, a.samples, a.strategy, strength=a.strength)
    found = embed.reembedded(some, papers_source.load_metadata(spark, a.metadata), _embedder(a), a.concurrency).persist()
    for side in ("title", "abstract"):
        _show(quality.audit(found, f"{side}_similarity"), None)


def do_sample(spark: SparkSession, a) -> None:
    rows = stores.read_store(spark, a.vectors).select("paper_id", "row_index")
    total = rows.count()
    some = sampling.sample(rows, a.samples, a.strategy, strength=a.strength, total=total)
    _show(sampling.quartiles(some, total), None)
    _show(sampling.mean_position(some, total), None)
    _show(sampling.density(some, total).orderBy("bin"), None)
    _show(some.orderBy("row_index"), a.out)


def do_import(spark: SparkSession, a) -> None:
    new = collection.points(stores.read_store(spark, a.vectors), papers_source.load_metadata(spark, a.metadata), a.start, a.limit)
    if a.store:
        new = new.withColumn("paper_id", F.col("payload.paper_id"))
        there = clustered.PaperStore(spark, a.store)
        if not there.points.exists():
            there = clustered.PaperStore.create(spark, a.store, new, metric=a.metric)
        print(f"buckets written: {len(there.upsert(new))}, points: {there.points.rows()}")
        return
    collection.create(spark, a.collection, new, a.recreate, a.metric)
    collection.upsert(spark, a.collection, new)


def do_articles(spark: SparkSession, a) -> None:
    rows = pubmed.read_articles(spark, a.input, a.strict_ids)
    sinks.write_parts_by_file(rows, a.out)
    if a.workbooks:
        _show(sinks.write_workbooks(spark.read.parquet(a.out), a.workbooks), None)
    _show(pubmed.file_report(spark.read.parquet(a.out)), None)


def do_manifest(spark: SparkSession, a) -> None:
    wanted = stores.download_manifest(spark, a.first, a.last)
    if a.fetch:
        done = stores.fetch(wanted.repartition(a.at_once), a.url, a.fetch).persist()
        _show(stores.fetch_report(done), None)
        _show(done.where("error is not null"), a.out)
        return
    _show(wanted, a.out)


def do_lookup(spark: SparkSession, a) -> None:
    if a.store:
        there = clustered.PaperStore(spark, a.store)
        found = there.of_paper(a.paper_id) if a.paper_id is not None else there.of_point(a.index)
        return _show(found.select("point_id", "paper_id", "payload", *[c for s in ("title", "abstract") if s in found.columns for c in (F.size(s).alias(f"{s}_dim"), V.preview(s).alias(f"{s}_preview"))]), a.out)
    v = stores.read_store(spark, a.vectors)
    _show(stores.store_structure(v), None)
    one = v.where(F.col("paper_id") == a.paper_id) if a.paper_id is not None else v.where(F.col("row_index") == a.index)
    shown = one.select("paper_id", "row_index", *[c for s in ("title", "abstract") for c in (F.size(f"{s}_embedding").alias(f"{s}_dim"), V.norm(f"{s}_embedding").alias(f"{s}_norm"), V.preview(f"{s}_embedding").alias(f"{s}_preview"))])
    _show(shown, a.out)
    if a.pca:
        _show(quality.principal_components(sampling.sample(v, a.pca), "title_embedding"), None)


def do_convert(spark: SparkSession, a) -> None:
    """A store of either format as one of the other."""
    rows = stores.read_store(spark, a.vectors)
    if a.out.endswith((".h5", ".hdf5")):
        count = [F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")]
        _show(hdf5.write_hdf5(rows.repartitionByRange(a.files, "row_index").sortWithinPartitions("row_index"), a.out, dtype=a.dtype).agg(*count), None)
    else:
        rows.write.mode("errorifexists").option("compression", "zstd").parquet(a.out)


def do_compare(spark: SparkSession, a) -> None:
    """Vectors that several stores have of the same papers."""
    backends = None
    for path in a.stores:
        part = stores.read_store(spark, path).select(F.col("paper_id").alias("text_id"), F.lit(path).alias("backend"), F.col(f"{a.side}_embedding").alias("v"))
        backends = part if backends is None else backends.unionByName(part)
    found = compare.agreement(backends)
    _show(found, a.out)
    _show(quality.passes(found), None)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corvane", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, run, *groups: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        for flag, kw in [x for g in groups for x in GROUPS[g]]:
            p.add_argument(flag, **kw)
        return p

    add("profile", do_profile, "input", "out").add_argument("--required", default="id,title,abstract")
    commands.choices["profile"].add_argument("--filtered")
    commands.choices["profile"].add_argument("--sample", type=int)
    add("lengths", do_lengths, "input").add_argument("--model_max", type=int, default=4096)
    commands.choices["lengths"].add_argument("--summary")
    add("embed", do_embed, "input", "must_out", "window", "embedder").add_argument("--stream", action="store_true")
    p = add("search", do_search, "some_vectors", "out", "embedder")
    p.add_argument("--parts", nargs=2, metavar=("TITLE", "ABSTRACT"), help="NPZ parts of each side, comma-separated, in place of --vectors")
    p.add_argument("--interactive", action="store_true", help="read questions from standard input, over vectors that stay loaded")
    p.add_argument("--query", default="")
    p.add_argument("--paper_id")
    p.add_argument("--metadata")
    p.add_argument("--side", choices=["title", "abstract", "combined", "mean"], default="combined")
    p.add_argument("--metric", choices=["cosine", "dot", "euclidean"], default="cosine")
    p.add_argument("--candidates", action="store_true", help="fuse the best of each side instead of scoring all rows")
    p.add_argument("--top_k", type=int, default=10)
    p.add_argument("--threshold", type=float)
    p = add("merge", do_merge, "must_out")
    p.add_argument("inputs", nargs="+")
    p.add_argument("--keep_duplicates", action="store_true")
    add("failed", do_failed, "input", "vectors", "must_out").add_argument("--logs", nargs="*", default=[])
    add("stats", do_stats, "vectors").add_argument("--export")
    add("audit", do_audit, "vectors", "samples", "embedder").add_argument("--metadata", required=True)
    add("sample", do_sample, "vectors", "samples", "out")
    p = add("import", do_import, "vectors", "window")
    p.add_argument("--metadata", required=True)
    p.add_argument("--collection", default="papers")
    p.add_argument("--store", help="a clustered store in this folder, in place of a table")
    p.add_argument("--recreate", action="store_true")
    p.add_argument("--metric", choices=["cosine", "dot", "euclidean"], default="cosine")
    p = add("lookup", do_lookup, "some_vectors", "out")
    p.add_argument("--store", help="a clustered store that import --store made, in place of --vectors")
    p.add_argument("--paper_id")
    p.add_argument("--index", type=int, default=0)
    p.add_argument("--pca", type=int, help="show principal components of so many sampled rows")
    p = add("convert", do_convert, "vectors", "must_out")
    p.add_argument("--files", type=int, default=1, help="HDF5 files to write")
    p.add_argument("--dtype", choices=["float16", "float32"], default="float16")
    p = add("compare", do_compare, "out")
    p.add_argument("stores", nargs="+")
    p.add_argument("--side", choices=["title", "abstract"], default="title")
    add("articles", do_articles, "input", "must_out").add_argument("--strict_ids", action="store_true")
    commands.choices["articles"].add_argument("--workbooks", help="a shared folder for one XLSX workbook a file")
    p = add("manifest", do_manifest, "out")
    p.add_argument("--first", type=int, default=1)
    p.add_argument("--last", type=int, default=1274)
    p.add_argument("--fetch", help="a shared folder into which the files are fetched")
    p.add_argument("--url", default="")
    p.add_argument("--at_once", type=int, default=5)
    return top


GROUPS = {
    "input": [("--input", {"required": True})],
    "vectors": [("--vectors", {"required": True})],
    "some_vectors": [("--vectors", {})],
    "out": [("--out", {})],
    "must_out": [("--out", {"required": True})],
    "window": [("--start", {"type": int, "default": 0}), ("--limit", {"type": int})],
    "samples": [("--samples", {"type": int, "default": 1000}), ("--strategy", {"default": "random", "choices": ["random", "exponential_decay", "linear_decay", "tail_heavy"]}), ("--strength", {"type": float, "default": 0.8})],
    "embedder": [("--api", {"default": "hash", "choices": ["hash", "openai", "tei"]}), ("--url", {"default": ""}), ("--model", {"default": ""}), ("--dim", {"type": int, "default": 64}), ("--prompt", {"choices": sorted(PROMPTS)}), ("--concurrency", {"type": int, "default": 4})],
}


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(session(f"corvane {a.command}"), a)


if __name__ == "__main__":
    main()
