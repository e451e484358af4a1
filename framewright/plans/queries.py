"""The operators bound to the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import exprs
from framewright.operators import attempts, ledger, publish, selectors, sequences, stats, tasks, trim
from framewright.plans.oracle import sql
from framewright.sources import archives, documents, files, media
from framewright.sources import bindings as b
from framewright.sources.scratch import new_folder
from framewright.sources.versions import VersionedTable
from framewright.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
SHARDS, BATCH, MOST, TTL = 4, 25, 3, 900


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = sql(oracle)
        return f

    return add


def _specs(s, d):
    return trim.trim_specs(b.padding(s, d))


def _status(s, d):
    return tasks.completion_status(b.tasks(s, d), b.sidecars(s, d), b.outputs(s, d), b.CONFIG)


def _layout(s, d):
    return selectors.subset_layout(b.tree(s, d))


def _payload(text) -> "F.Column":
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def _videos(s, d, content) -> str:
    """A folder with the videos of all tasks; content: an expression of a document's text."""
    root = new_folder(s)
    docs = s.read.parquet(f"{d}/documents.parquet").select("doc_id", content.alias("content"))
    files.write_media(b.tree(s, d).filter("path like '%.mp4'").join(docs, "doc_id").select("path", "content"), root)
    return root


# sources


def _descriptors(s, d) -> DataFrame:
    """The descriptors, written into a folder for each subset and scanned."""
    root = new_folder(s)
    files.write_media(documents.descriptor_files(b.descriptors(s, d)), root)
    return documents.scan_descriptors(s, root)


@query("""SELECT subset, printf('%03d', chunk) AS chunk, count(*) AS frames, count(DISTINCT episode_index) AS episodes, CAST(sum(length(text)) AS BIGINT) AS chars,
    min(subset || printf('/data/chunk-%03d/episode_%06d.parquet', chunk, episode_index)) AS first_path FROM (
    SELECT e.subset, episode_index // chunks_size AS chunk, f.* FROM frames f JOIN subset_episodes e USING (episode_index) JOIN described t ON t.subset = e.subset WHERE issue IS NULL) GROUP BY 1, 2""")
def scan_frames(s, d):
    root, paths = new_folder(s), documents.episode_files(b.subset_episodes(s, d), _descriptors(s, d))
    kept = new_folder(s)
    paths.write.parquet(kept)
    paths = s.read.schema(paths.schema).parquet(kept)
    rows = b.frames(s, d).join(paths, "episode_index")
    rows.select(*b.frames(s, d).columns, "subset", F.format_string("%03d", "episode_chunk").alias("chunk")).write.partitionBy("subset", "chunk").parquet(root)
    found = files.scan_frames(s, root).join(paths.select("episode_index", "subset", "path"), "episode_index")
    return found.groupBy("subset", "chunk").agg(F.count("*").alias("frames"), F.countDistinct("episode_index").alias("episodes"), F.sum(F.length("text")).alias("chars"), F.min("path").alias("first_path"))


_EXTRA = """'"extra":{"gains":[0.5,null,{"k":' || episode_index || '}],"note":' || CASE WHEN episode_index % 3 = 0 THEN 'null' ELSE '"ça ' || episode_index || '"' END || '}'"""


@query(f"""SELECT episode_index, length, '{{' || {_EXTRA} || ',"tasks":["pick","place"]}}' AS rest FROM episodes""")
def scan_episode_jsonl(s, d):
    path = new_folder(s)
    b.episode_rows(s, d).write.text(path)
    row = F.col("row")
    known = ("episode_index", "length")
    rest = F.to_json(F.map_filter(row.cast("map<string,variant>"), lambda k, _: ~k.isin(*known)))
    return documents.scan_json_rows(s, path).select(*[F.variant_get(row, f"$.{k}", "long").alias(k) for k in known], rest.alias("rest"))


@query("SELECT episode_index, camera, frame_count, tail_missing_count, len(missing_frame_indices) AS n_missing FROM padding")
def scan_padding_sidecars(s, d):
    root = new_folder(s)
    source = F.struct("episode_index", "frame_count", "tail_missing_count", "missing_frame_indices").alias("source")
    b.padding(s, d).select("camera", source).write.partitionBy("camera").json(root)
    return files.scan_padding_sidecars(s, [root]).select("episode_index", "camera", "frame_count", "tail_missing_count", F.size("missing_frame_indices").cast("long").alias("n_missing"))


_VIDEOS = "(SELECT t.path, t.subset, d.doc_id, coalesce(d.text, '') AS text FROM tree t JOIN documents d USING (doc_id) WHERE path LIKE '%.mp4')"


@query(f"SELECT path, subset, split_part(substr(path, length(subset) + 2), '/', 2) AS chunk, split_part(substr(path, length(subset) + 2), '/', 3) AS input_camera, regexp_extract(path, '(episode_[0-9]+)\\.mp4$', 1) AS episode, strlen(text) AS bytes FROM {_VIDEOS}")
def media_catalog(s, d):
    return files.media_catalog(media.scan_headers(s, _videos(s, d, _payload(F.col("text"))), header=0))


@query(f"SELECT path, starts_with(hex(encode(body))[9:], '66747970') AND strlen(body) >= 12 AS is_mp4 FROM (SELECT path, CASE WHEN doc_id % 3 = 0 THEN '0000ftyp' || text ELSE text END AS body FROM {_VIDEOS})")
def media_signature(s, d):
    text = F.coalesce(F.col("text"), F.lit(""))
    root = _videos(s, d, _payload(F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("0000ftyp"), text)).otherwise(text)))
    return media.scan_headers(s, root).select("path", files.has_mp4_signature(F.col("header")).alias("is_mp4"))


@query("""SELECT DISTINCT 'any marker' AS rule, subset FROM tree UNION ALL SELECT DISTINCT 'videos', subset FROM tree UNION ALL SELECT DISTINCT 'images', subset FROM tree WHERE path LIKE '%/images/%'""")
def subset_discovery(s, d):
    tree = b.tree(s, d)
    rules = {"any marker": selectors.subset_discovery(tree), "videos": selectors.marked_roots(tree, "videos"), "images": selectors.marked_roots(tree, "images", least=1)}
    return reduce(DataFrame.unionByName, [rows.select(F.lit(rule).alias("rule"), "subset") for rule, rows in rules.items()])


@query("SELECT subset, root, chunks FROM layout")
def subset_layout(s, d):
    return _layout(s, d)


# sinks


@query("""SELECT episode_index, frame_index, role, text, printf('%03d', episode_index % 6) AS chunk, printf('%03d', episode_index % 6) IN (SELECT printf('%03d', episode_index % 6) FROM specs) AS rewritten, 'gzip' AS codec FROM trimmed""")
def write_frames(s, d):
    table, specs = VersionedTable(s, new_folder(s)), _specs(s, d)
    chunk = F.format_string("%03d", F.col("episode_index") % 6)
    table.append(b.frames(s, d).withColumn("chunk", chunk), "chunk", "gzip")
    first = table.current()
    before = {folder for _, folder in first.folders}
    now = files.rewrite_frames(table, trim.tail_trim(table.read(first), specs), specs.select(chunk.alias("chunk")))
    new = [key for key, folder in now.folders if folder not in before]
    codec = files.codec_of(s, table.root + "/" + now.folders[-1][1]) if now.folders else None
    return table.read(now).select("episode_index", "frame_index", "role", "text", "chunk", F.col("chunk").isin(new).alias("rewritten"), F.lit(codec).alias("codec"))


@query(f"""SELECT episode_index, '{{"episode_index":' || episode_index || ',' || {_EXTRA} || ',"length":' || coalesce(length - trim_count, length) || ',"tasks":["pick","place"]}}' AS line FROM episodes LEFT JOIN specs USING (episode_index)""")
def write_jsonl(s, d):
    old, new = new_folder(s), new_folder(s)
    b.episode_rows(s, d).write.text(old)
    rows = documents.scan_json_rows(s, old).withColumn("episode_index", F.variant_get("row", "$.episode_index", "long"))
    final = rows.join(_specs(s, d), "episode_index", "left").withColumn("final", F.coalesce(F.col("original_length") - F.col("trim_count"), F.variant_get("row", "$.length", "long")))
    documents.write_json_rows(final.select(documents.with_keys(F.col("row"), length=F.col("final")).alias("row")), "row", new)
    lines = s.read.text(new)
    return lines.select(F.get_json_object("value", "$.episode_index").cast("long").alias("episode_index"), F.col("value").alias("line"))


@query("SELECT task, event_id, event, substr(sha256('/data' || chr(0) || (task % 4) || chr(0) || '' || chr(0) || '1024'), 1, 16) AS scope FROM ledger")
def append_events(s, d):
    path, scope = new_folder(s), ledger.run_scope(F.lit("/data"), F.col("task") % 4, F.lit(None), F.lit(1024))
    rows = b.ledger(s, d).select("task", "event_id", "event", scope.alias("scope"))
    files.append_events(rows.filter("event <> 'resolved'"), path, "scope")
    files.append_events(rows.filter("event = 'resolved'"), path, "scope")
    return files.scan_jsonl(s, path, "task long, event_id long, event string, scope string")


@query("""SELECT subset, chunk, input_camera, batch, CASE WHEN chunk LIKE '%1' THEN 'skipped' ELSE 'created' END AS status,
    subset || '/images/' || chunk || '/' || input_camera || '/episodes-' || substr(min(episode), 9) || '-' || substr(max(episode), 9) || '.tar' AS archive,
    count(*) AS members, CAST(sum(strlen(coalesce(text, ''))) AS BIGINT) AS payload_bytes FROM batched JOIN documents USING (doc_id) GROUP BY subset, chunk, input_camera, batch""")
def pack_export(s, d):
    texts = s.read.parquet(f"{d}/documents.parquet").select("doc_id", _payload(F.col("text")).alias("payload"))
    batches, shard, folder = tasks.pack_batches(b.tasks(s, d), BATCH), ["subset", "chunk", "input_camera", "batch"], new_folder(s)
    archive = F.concat_ws("/", "subset", F.lit("images"), "chunk", "input_camera", "file").alias("archive")
    names = tasks.shard_summary(batches).select(*shard, archive)
    members = batches.join(texts, "doc_id").join(names, shard).withColumn("member", F.concat("episode", F.lit(".txt")))
    archives.pack_export(members.filter("chunk like '%1'"), shard, folder)  # an earlier run
    return archives.pack_export(members, shard, folder)


@query("""SELECT * FROM (SELECT 'conflict' AS staged, doc_id, (SELECT count(*) FROM tasks WHERE doc_id IN (SELECT doc_id FROM labels)) AS conflicts, NULL AS published FROM tasks WHERE doc_id IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 20)
    UNION ALL SELECT 'new', NULL, 0, count(*) FROM tasks WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def publish_staged(s, d):
    staged, labels, table = b.tasks(s, d), s.read.parquet(f"{d}/labels.parquet").select("doc_id"), VersionedTable(s, new_folder(s))
    table.append(staged.join(labels, "doc_id", "left_semi"))
    before, none = table.current(), F.lit(None).cast("long")
    refused = publish.publish_staged(staged, table, ["doc_id"]).select(F.lit("conflict").alias("staged"), "doc_id", "conflicts", none.alias("published"))
    publish.publish_staged(staged.join(labels, "doc_id", "left_anti"), table, ["doc_id"])
    done = table.read().join(table.read(before).select("doc_id"), "doc_id", "left_anti").agg(F.count("*").alias("published"))
    return refused.unionByName(done.select(F.lit("new").alias("staged"), none.alias("doc_id"), F.lit(0).cast("long").alias("conflicts"), "published"))


# projections


@query("""SELECT subset, chunk, input_camera, episode, replace(input_camera, 'rgb_', 'normal_') AS output_camera, CAST(substr(episode, 9) AS BIGINT) AS episode_index,
    subset || '/videos/' || chunk || '/' || input_camera || '/' || episode || '.mp4' AS input_path,
    subset || '/videos/' || chunk || '/' || replace(input_camera, 'rgb_', 'normal_') || '/' || episode || '.mp4' AS output_path,
    subset || '/meta/normals/' || chunk || '/' || replace(input_camera, 'rgb_', 'normal_') || '/' || episode || '.json' AS metadata_path,
    sha256('{"chunk":"' || chunk || '","episode":"' || episode || '","input_camera":"' || input_camera || '","subset":"' || subset || '"}') AS task_key FROM tasks""")
def task_table(s, d):
    return tasks.task_table(b.tasks(s, d))


@query("""SELECT media_id, subset, out_width, out_height, pad_x, pad_y, stride, kept_frames, batches, windows, NULL AS media FROM media_plans
    UNION ALL SELECT NULL, subset, NULL, NULL, NULL, NULL, NULL, CAST(sum(kept_frames) AS BIGINT), CAST(sum(batches) AS BIGINT), CAST(sum(windows) AS BIGINT), count(*) FROM media_plans GROUP BY ROLLUP (subset)""")
def media_plan(s, d):
    plan = sequences.media_plan(b.media(s, d), 1024, 12)
    return plan.unionByName(sequences.media_totals(plan, "subset"), allowMissingColumns=True)


@query("""SELECT episode_index, frame_index, array_to_string(list_transform(e, lambda x: CAST(trunc(least(greatest((x / greatest(n, 1e-6) * 0.5 + 0.5) * 255, 0), 255)) AS INT)), ',') AS codes FROM (
    SELECT episode_index, frame_index, CAST(observation_state AS DOUBLE[]) AS e, sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(CAST(observation_state AS DOUBLE[]), lambda x: x * x)), lambda a, c: a + c)) AS n FROM vecframes)""")
def normalize_quantize_vectors(s, d):
    v = b.vecframes(s, d)
    return v.select("episode_index", "frame_index", F.array_join(stats.quantized_normals(v, "observation_state").cast("array<string>"), ",").alias("codes"))


# filters


@query("""SELECT 'bounds' AS selection, subset, chunk, input_camera, episode FROM tasks WHERE subset IN ('src0', 'src1', 'src2') AND chunk IN ('chunk-000', 'chunk-001', 'chunk-003') AND input_camera LIKE '%rgb_01' AND CAST(substr(episode, 9) AS BIGINT) BETWEEN 10 AND 350
    UNION ALL SELECT 'episodes', subset, chunk, input_camera, episode FROM tasks WHERE doc_id % 7 = 3 AND doc_id < 150""")
def select_tasks(s, d):
    rows = b.tasks(s, d)
    episodes = [f"episode_{n:06d}" if n % 2 else str(n) for n in range(3, 150, 7)]
    picked = {"bounds": tasks.select_tasks(rows, ("src0", "src1", "src2"), (0, 1, 3), ("01",), 10, 350), "episodes": tasks.select_tasks(rows, episodes=episodes)}
    return reduce(DataFrame.unionByName, [x.select(F.lit(name).alias("selection"), *tasks.ORDER) for name, x in picked.items()])


_CAMERA = "(r.camera = input_camera OR r.camera = split_part(input_camera, '.', 3) OR r.camera = right(input_camera, 2))"


@query(f"""SELECT request_id, r.subset, r.chunk, input_camera, episode, NULL AS issue FROM wanted r JOIN tasks t ON r.subset = t.subset AND r.chunk = t.chunk AND {_CAMERA}
    UNION ALL SELECT request_id, r.subset, t.chunk, input_camera, episode, NULL FROM requests r JOIN tasks t ON r.subset = t.subset AND {_CAMERA} WHERE r.chunks = ''
    UNION ALL SELECT request_id, NULL, NULL, NULL, NULL, 'invalid chunks' FROM requests WHERE chunks = '7-5'""")
def resolve_requests(s, d):
    requests = b.requests(s, d)
    return tasks.resolve_requests(requests, b.tasks(s, d)).unionByName(selectors.request_issues(requests), allowMissingColumns=True)


def _patterns(s, d):
    return selectors.pattern_plan(_layout(s, d), selectors.parsed_requests(b.plans(s, d)))


@query("""SELECT 'checked' AS plan, request_id, subset, position, pattern, NULL AS issue FROM planned
    UNION ALL SELECT DISTINCT 'checked', request_id, subset, NULL, NULL, issue FROM checked WHERE issue IS NOT NULL
    UNION ALL SELECT 'unverified', request_id, subset, row_number() OVER (PARTITION BY request_id, subset ORDER BY place) - 1, pattern, NULL FROM (SELECT request_id, subset, pattern, min(place) AS place FROM unverified GROUP BY 1, 2, 3)""")
def pattern_plan(s, d):
    patterns, issues = _patterns(s, d)
    dry = selectors.unverified_plan(selectors.parsed_requests(b.plans(s, d)))
    checked = patterns.unionByName(issues, allowMissingColumns=True).withColumn("plan", F.lit("checked"))
    return checked.unionByName(dry.withColumn("plan", F.lit("unverified")), allowMissingColumns=True)


@query("SELECT DISTINCT path FROM tree t JOIN globs g ON t.subset = g.subset AND regexp_full_match(path, rx)")
def pattern_filter(s, d):
    return selectors.pattern_filter(b.tree(s, d), _patterns(s, d)[0])


@query("SELECT episode_index, frame_index, role FROM trimmed")
def tail_trim(s, d):
    return trim.tail_trim(b.frames(s, d), _specs(s, d)).select("episode_index", "frame_index", "role")


# joins


@query("SELECT episode_index, trim_count, original_length FROM specs WHERE episode_index % 13 = 0")
def missing_episodes(s, d):
    return trim.missing_episodes(_specs(s, d), b.episodes(s, d).filter("episode_index % 13 <> 0"))


@query("""SELECT s.episode_index, what, found, original_length, original_length - trim_count AS final_length,
    CASE WHEN found = original_length THEN 'to_trim' WHEN found = original_length - trim_count THEN 'trimmed' ELSE 'error' END AS state
    FROM specs s JOIN (SELECT episode_index, 'metadata' AS what, length AS found FROM episodes UNION ALL SELECT episode_index, 'table', length FROM episodes
    UNION ALL SELECT episode_index, media_key, frames FROM media_counts) m ON s.episode_index = m.episode_index""")
def length_audit(s, d):
    return trim.length_audit(_specs(s, d), b.episodes(s, d), b.frames(s, d), b.media_counts(s, d))


@query("SELECT episode_index, camera FROM padding p WHERE tail_missing_count > 0 AND NOT EXISTS (SELECT 1 FROM media_counts m WHERE m.episode_index = p.episode_index AND m.media_key = p.camera)")
def padded_camera_coverage(s, d):
    return trim.padded_camera_coverage(b.padding(s, d), b.media_counts(s, d))


@query("SELECT DISTINCT subset FROM requests WHERE subset NOT IN (SELECT subset FROM tasks)")
def unknown_selectors(s, d):
    return selectors.unknown_selectors(b.requests(s, d), b.tasks(s, d))


@query(f"""SELECT DISTINCT request_id, subset, camera, chunk FROM (SELECT request_id, subset, camera, chunk FROM wanted UNION ALL
    SELECT request_id, q.subset, camera, min(chunk) FROM requests q JOIN tasks t ON q.subset = t.subset WHERE chunks = '' GROUP BY 1, 2, 3) r
    WHERE NOT EXISTS (SELECT 1 FROM tasks t WHERE t.subset = r.subset AND t.chunk = r.chunk AND {_CAMERA})""")
def nested_modality_check(s, d):
    return selectors.nested_modality_check(b.requests(s, d), b.tasks(s, d)).distinct()


@query("SELECT pattern FROM globs g WHERE NOT EXISTS (SELECT 1 FROM tree t WHERE t.subset = g.subset AND regexp_full_match(path, rx))")
def pattern_coverage(s, d):
    return selectors.pattern_coverage(b.tree(s, d), _patterns(s, d)[0])


@query("SELECT doc_id, subset, chunk, input_camera, episode, complete, quarantined FROM status")
def completion_status(s, d):
    return _status(s, d).drop("input_size_bytes")


@query("SELECT doc_id, subset, chunk, input_camera, episode FROM status WHERE NOT complete AND NOT quarantined")
def pending_tasks(s, d):
    return tasks.pending_tasks(_status(s, d)).select("doc_id", *tasks.ORDER)


@query("SELECT doc_id, 'resolved' AS event FROM status WHERE complete AND quarantined")
def auto_resolve(s, d):
    return tasks.auto_resolve(_status(s, d))


@query("SELECT doc_id, episode FROM tasks WHERE doc_id IN (SELECT doc_id FROM labels)")
def publish_conflicts(s, d):
    return publish.publish_conflicts(b.tasks(s, d), s.read.parquet(f"{d}/labels.parquet"), ["doc_id"]).select("doc_id", "episode")


# aggregations


@query("""SELECT *, NULL AS issue FROM specs UNION ALL SELECT episode_index, NULL, NULL, NULL, NULL, 'frame counts differ' FROM specs WHERE conflict
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 'no specs' WHERE NOT EXISTS (SELECT 1 FROM specs)""")
def trim_specs(s, d):
    return _specs(s, d).unionByName(trim.trim_spec_issues(b.padding(s, d)), allowMissingColumns=True)


def _digits(stats_of: str) -> str:
    """min, max, mean and std of the dimensions in millionths, as lists."""
    codes = [("min", "min(v)"), ("max", "max(v)"), ("mean", "avg(v)"), ("std", "CASE WHEN min(v) = max(v) THEN 0 ELSE stddev_pop(v) END")]
    lists = ", ".join(f"string_agg(CAST(round({n} * 1000000) AS BIGINT), ',' ORDER BY dim) AS {n}" for n, _ in codes)
    return f"{stats_of}, {lists}, max(count) AS count FROM (SELECT episode_index, feature, dim, count(*) AS count, {', '.join(f'{f} AS {n}' for n, f in codes)} FROM tall GROUP BY ALL) GROUP BY ALL"


def _coded(rows: DataFrame) -> DataFrame:
    code = lambda c: F.array_join(F.transform(c, lambda x: F.round(x * 1000000).cast("long").cast("string")), ",")
    return rows.withColumns({c: code(c) for c in ("min", "max", "mean", "std")})


def _features(s, d) -> list[str]:
    path = new_folder(s)
    b.stats_rows(s, d).write.text(path)
    return stats.stats_features(documents.scan_json_rows(s, path))


@query(_digits("SELECT episode_index, feature"))
def episode_stats(s, d):
    return _coded(stats.episode_stats(b.statframes(s, d), _features(s, d)))


@query(_digits("SELECT feature").replace("SELECT episode_index, feature, dim", "SELECT feature, dim"))
def global_stats(s, d):
    return _coded(stats.global_stats(stats.accumulators(b.statframes(s, d), _features(s, d))))


@query("SELECT episode_index, role, count(*) AS frames, min(frame_index) AS first_frame, max(frame_index) AS last_frame, min(frame_index) = 0 AND max(frame_index) = count(*) - 1 AND count(DISTINCT frame_index) = count(*) AS contiguous FROM frames GROUP BY ALL")
def media_frame_counts(s, d):
    return trim.media_frame_counts(b.frames(s, d), ["episode_index", "role"])


@query("""SELECT t.subset, issue, coalesce(episodes, 0) AS total_episodes, coalesce(frames, 0) AS total_frames, coalesce(frames, 0) * images AS total_images,
    '{"codebase_version":"v2.1","robot":{"joints":[1,2,null],"name":"' || t.subset || '"},"note":null,"total_frames":' || coalesce(frames, 0) || ',"chunks_size":' || chunks_size
    || ',"data_path":"data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet","features":{' || CASE WHEN n % 2 = 0 THEN '"observation.images.depth_02":{"dtype":"image","shape":[36,64]},' ELSE '' END
    || CASE WHEN n % 3 = 0 THEN '"observation.images.depth_03":{"dtype":"image","shape":[36,64]},' ELSE '' END || '"observation.images.rgb_01":{"dtype":"video"},"observation.state":{"dtype":"float32"}},"fps":15,"total_images":' || coalesce(frames, 0) * images || '}' AS document
    FROM described t LEFT JOIN (SELECT subset, count(*) AS episodes, CAST(sum(length) AS BIGINT) AS frames FROM subset_episodes GROUP BY 1) e USING (subset) WHERE issue IS NULL
    UNION ALL SELECT subset, issue, NULL, NULL, NULL, NULL FROM described WHERE issue IS NOT NULL""")
def dataset_totals(s, d):
    found, root = _descriptors(s, d), new_folder(s)
    good = documents.usable_descriptors(found)
    totals = documents.dataset_totals(b.subset_episodes(s, d), good)
    files.write_media(documents.descriptor_files(documents.with_totals(good, totals)), root)
    again = documents.scan_descriptors(s, root).select("subset", "document", "info.total_frames", "info.total_images")
    return again.join(totals.select("subset", "total_episodes"), "subset").unionByName(documents.descriptor_issues(found), allowMissingColumns=True)


@query("""SELECT (SELECT count(*) FROM specs) AS affected_episodes, (SELECT count(*) FROM specs WHERE trim_count = 0) AS already_trimmed,
    (SELECT CAST(sum(trim_count) AS BIGINT) FROM specs) AS frames_to_delete, (SELECT count(*) FROM specs WHERE trim_count > 0) AS rewritten_files,
    (SELECT count(*) FROM specs s JOIN media_counts m USING (episode_index) WHERE m.frames = s.original_length) AS media_to_trim""")
def trim_report(s, d):
    return trim.trim_report(b.frames(s, d), _specs(s, d), b.media_counts(s, d))


@query("""SELECT subset, chunk, input_camera, batch, count(*) AS episodes, min(episode) AS first_episode, max(episode) AS last_episode, CAST(sum(input_size_bytes) AS BIGINT) AS size_bytes,
    'episodes-' || substr(min(episode), 9) || '-' || substr(max(episode), 9) || '.tar' AS file FROM batched GROUP BY ALL""")
def shard_summary(s, d):
    return tasks.shard_summary(tasks.pack_batches(b.tasks(s, d), BATCH))


@query("SELECT shard, count(*) AS discovered, count(*) FILTER (NOT complete) AS pending, count(*) FILTER (quarantined AND NOT complete) AS quarantined FROM sharded GROUP BY ROLLUP (shard)")
def plan_counts(s, d):
    return tasks.plan_counts(_status(s, d), SHARDS)


@query("""SELECT * FROM (SELECT task % 4 AS shard, count(*) FILTER (event = 'process_crash') AS process_crash, count(*) FILTER (event = 'python_failure') AS python_failure, count(*) FILTER (event = 'resolved') AS resolved FROM ledger GROUP BY 1)
    FULL JOIN (SELECT shard, count(*) FILTER (outcome = 'complete') AS succeeded, count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'locked') AS locked, count(*) FILTER (outcome = 'failed') AS failed,
    count(*) FILTER (NOT complete AND coalesce(outcome NOT IN ('complete', 'skipped'), true)) AS still_pending FROM run GROUP BY 1) USING (shard)""")
def run_summary(s, d):
    run = tasks.run_summary(b.outcomes(tasks.stable_shards(_status(s, d), SHARDS)))
    return ledger.failure_counts(b.ledger(s, d), SHARDS).join(run, "shard", "full")


@query("SELECT doc_id, 1 + CAST(doc_id % 2 AS BIGINT) AS parts, input_size_bytes // 2 * (1 + doc_id % 2) AS part_bytes FROM tasks WHERE doc_id % 3 = 0")
def orphan_parts(s, d):
    t = b.tasks(s, d).filter("doc_id % 3 = 0").withColumn("k", F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 2).cast("int"))))
    path = F.concat_ws("/", "subset", F.lit("videos"), "chunk", exprs.output_camera(F.col("input_camera")), F.concat(F.lit("."), F.col("episode"), F.lit("."), F.col("k").cast("string"), F.lit(".part.mp4")))
    manifest = t.select("subset", "chunk", path.alias("path"), F.expr("input_size_bytes DIV 2").alias("bytes"))
    return tasks.orphan_parts(manifest, b.tasks(s, d))


_QUARANTINED = "(SELECT task, max_by(event, (ts, event_id)) AS event, max_by(status, (ts, event_id)) AS status FROM states GROUP BY 1)"


@query(f"""SELECT event AS failure_kind, count(*) AS tasks, NULL AS task FROM {_QUARANTINED} WHERE status = 'quarantined' GROUP BY 1
    UNION ALL SELECT * FROM (SELECT event, NULL, task FROM {_QUARANTINED} WHERE status = 'quarantined' ORDER BY task LIMIT 50)""")
def quarantine_summary(s, d):
    events = b.ledger(s, d)
    return ledger.quarantine_summary(ledger.crash_quarantine(events, MOST), events)


# windows


@query("SELECT episode_index, frame_index, row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS index FROM trimmed")
def global_reindex(s, d):
    return trim.trim_and_reindex(b.frames(s, d), _specs(s, d))


@query("SELECT episode_index, count(*) AS frames, count(*) FILTER (frame_index <> place) AS misplaced FROM (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS place FROM frames) GROUP BY 1")
def frame_index_audit(s, d):
    return trim.frame_index_audit(b.frames(s, d))


@query("SELECT episode_index, camera, missing_frame_indices = range(frame_count - tail_missing_count, frame_count) AS pure_tail FROM padding")
def pure_tail_audit(s, d):
    return trim.pure_tail_audit(b.padding(s, d))


@query("SELECT subset, chunk, input_camera, episode, CAST(batch AS BIGINT) AS batch FROM batched")
def pack_batches(s, d):
    return tasks.pack_batches(b.tasks(s, d), BATCH).select(*tasks.ORDER, "batch")


@query("SELECT doc_id, position, shard FROM sharded")
def stable_shards(s, d):
    return tasks.stable_shards(b.tasks(s, d), SHARDS).select("doc_id", "position", "shard")


@query("""SELECT episode_index, frame_index, stride, frame_index // stride AS sample FROM (SELECT *, CAST(CASE episode_index % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 5 END AS BIGINT) AS stride FROM frames)
    WHERE frame_index % stride = 0 AND frame_index // stride < 4""")
def frame_stride_sample(s, d):
    return sequences.frame_stride_sample(b.frames(s, d), exprs.rate(b.frame_rate(F.col("episode_index"))), 12, 4)


@query("SELECT episode_index, frame_index // 2 AS batch, count(*) AS frames, min(frame_index) AS first_frame, max(frame_index) AS last_frame FROM frames GROUP BY ALL")
def bounded_batches(s, d):
    return sequences.bounded_batches(b.frames(s, d), 2)


def _windows(view: str, size: int, step: int) -> str:
    return f"""SELECT f.*, w.win FROM {view} f JOIN (SELECT episode_index, count(*) AS n FROM {view} GROUP BY 1) USING (episode_index),
        LATERAL (SELECT unnest(range(0, CASE WHEN n <= {size} THEN 1 ELSE CAST(ceil((n - {size}) / {step}.0) AS BIGINT) + 1 END)) AS win) w WHERE frame_index >= win * {step} AND frame_index < win * {step} + {size}"""


@query(f"SELECT episode_index, frame_index, win AS \"window\" FROM ({_windows('frames', 3, 2)})")
def sliding_windows(s, d):
    return sequences.sliding_windows(b.frames(s, d), 3, 2)


@query(f"""SELECT episode_index, frame_index, string_agg(CAST(round(coalesce(v1 * wt + v2 * (1 - wt), v1) * 1000000) AS BIGINT), ',' ORDER BY dim) AS blended FROM (
    SELECT episode_index, frame_index, dim, min_by(v, win) AS v1, CASE WHEN count(*) > 1 THEN max_by(v, win) END AS v2, max_by(wt0, win) AS wt FROM (
    SELECT episode_index, frame_index, win, unnest(range(len(observation_state))) AS dim, unnest(CAST(observation_state AS DOUBLE[])) + win AS v,
    CASE WHEN frame_index - win * 10 < 4 THEN 1 - (frame_index - win * 10 + 1) / 5.0::DOUBLE ELSE 0 END AS wt0 FROM ({_windows('vecframes', 14, 10)}))
    GROUP BY episode_index, frame_index, dim) GROUP BY episode_index, frame_index""")
def overlap_blend(s, d):
    seen = sequences.window_frames(b.vecframes(s, d), "observation_state", 14, 10)
    # a window sees the vector plus its own number, so that blending shows
    seen = seen.withColumn("vector", F.transform("vector", lambda x: x + F.col("window")))
    blended = sequences.overlap_blend(seen, 14, 10)
    return blended.withColumn("blended", F.array_join(F.transform("blended", lambda x: F.round(x * 1000000).cast("long").cast("string")), ","))


@query("SELECT task, max_by(event, (ts, event_id)) AS event, max_by(event_id, (ts, event_id)) AS event_id, count(*) AS events FROM ledger GROUP BY 1")
def latest_task_state(s, d):
    return ledger.latest_task_state(b.ledger(s, d))


@query("SELECT task, event_id, CAST(attempt AS INT) AS attempt, CAST(CASE WHEN attempt < 3 THEN 5 * attempt END AS INT) AS wait_seconds, CAST(CASE WHEN attempt < 3 THEN 10 END AS INT) AS worker_wait_seconds, attempt = 3 AS exhausted FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY ts, event_id) AS attempt FROM ledger WHERE event = 'process_crash') WHERE attempt <= 3")
def retry_schedule(s, d):
    constant = ledger.retry_schedule(b.ledger(s, d), MOST, 10, linear=False).select("event_id", F.col("wait_seconds").alias("worker_wait_seconds"))
    return ledger.retry_schedule(b.ledger(s, d), MOST, 5).join(constant, "event_id")


@query("SELECT task, event_id, event, attempts, status FROM states")
def crash_quarantine(s, d):
    return ledger.crash_quarantine(b.ledger(s, d), MOST)


# order and limits


@query("SELECT subset, chunk, input_camera, episode FROM tasks ORDER BY ALL")
def ordered_plan(s, d):
    return b.tasks(s, d).select(*tasks.ORDER).orderBy(*tasks.ORDER)


@query("""SELECT shard, CAST(place AS INT) AS place, subset, chunk, input_camera, episode FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY position) AS place FROM sharded WHERE NOT complete AND NOT quarantined) WHERE place <= 50""")
def per_shard_limit(s, d):
    return tasks.per_shard_limit(_status(s, d), SHARDS, 50)


@query("SELECT subset, chunk, input_camera, episode, (SELECT greatest(count(*) - 20, 0) FROM tasks) AS more FROM tasks ORDER BY ALL LIMIT 20")
def preview_topk(s, d):
    return tasks.preview(b.tasks(s, d).select(*tasks.ORDER), tasks.ORDER, 20)


# set operations


@query("SELECT episode_index, camera, frame_count, tail_missing_count FROM padding")
def union_metadata_roots(s, d):
    p = b.padding(s, d).select("episode_index", "camera", "frame_count", "tail_missing_count")
    return p.filter("episode_index % 2 = 0").unionByName(p.filter("episode_index % 2 = 1"))


@query("""SELECT subset, NULL AS root, chunk FROM (SELECT subset, chunk FROM wanted_chunks EXCEPT SELECT subset, chunk FROM root_chunks)
    UNION ALL SELECT subset, root, chunk FROM (SELECT w.subset, root, w.chunk FROM wanted_chunks w JOIN (SELECT DISTINCT subset, root FROM root_chunks) r ON r.subset = w.subset EXCEPT SELECT subset, root, chunk FROM root_chunks)""")
def chunk_except(s, d):
    return selectors.chunk_except(b.plans(s, d), _layout(s, d))


# streams


def _stream(s, rows: DataFrame) -> DataFrame:
    path = new_folder(s)
    rows.write.parquet(path)
    return s.readStream.schema(rows.schema).parquet(path)


@query("SELECT task, event_id, event, attempts, status FROM states")
def stream_quarantine(s, d):
    return jobs.drained(jobs.quarantine_stream(_stream(s, jobs.ended(b.ledger(s, d))), MOST), new_folder(s), new_folder(s))


@query("""SELECT task, count(*) AS beats, max(ts) AS last_beat FROM sessions GROUP BY task, session
    HAVING max(ts) + INTERVAL 15 MINUTE < (SELECT max(ts) - INTERVAL 1 HOUR FROM heartbeats)""")
def stream_lease_expiry(s, d):
    out = jobs.drained(jobs.lease_stream(_stream(s, b.heartbeats(s, d)), TTL), new_folder(s), new_folder(s))
    return out.withColumn("last_beat", F.col("last_beat").cast("timestamp_ntz"))


@query("SELECT task, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(DISTINCT beat_id) AS outputs FROM heartbeats GROUP BY 1, 2")
def stream_new_outputs(s, d):
    beats, table = b.heartbeats(s, d), VersionedTable(s, new_folder(s))
    arrivals = beats.unionByName(beats.filter("beat_id % 5 = 0"))
    jobs.count_outputs(_stream(s, arrivals), table, new_folder(s), ["task", "day"])
    return table.read().select("task", F.col("day").cast("timestamp_ntz").alias("day"), "outputs")


# user functions


@query("""SELECT episode_index, CASE WHEN episode_index % 7 = 3 THEN 'failed' ELSE 'complete' END AS status, CASE WHEN episode_index % 7 = 3 THEN 3 ELSE 1 END AS attempt,
    CASE WHEN episode_index % 7 <> 3 THEN count(*) END AS count, CASE WHEN episode_index % 7 <> 3 THEN avg(length(text)) END AS value, CASE WHEN episode_index % 7 = 3 THEN 'ValueError' END AS error_type,
    CASE WHEN episode_index % 7 = 3 THEN 'bad episode' END AS error, episode_index % 7 = 3 AS traced, true AS timed FROM frames GROUP BY 1""")
def map_episodes_resilient(s, d):
    def measure(length, pdf):
        if pdf["episode_index"].iloc[0] % 7 == 3:
            raise ValueError("bad episode")
        return len(pdf), length(pdf["text"]).mean()

    out = attempts.map_episodes_durably(b.frames(s, d), "episode_index", measure, MOST, new_folder(s), setup=lambda: lambda texts: texts.str.len())
    traced = F.coalesce(F.col("traceback").contains("ValueError: bad episode"), F.lit(False)).alias("traced")
    return out.select("episode_index", "status", "attempt", "count", "value", "error_type", "error", traced, (F.col("wall_seconds") >= 0).alias("timed"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 6) AS norm FROM embeddings")
def map_batches_with_setup(s, d):
    def setup():
        import numpy

        return numpy

    def norms(np, pdf):
        return pdf[["vec_id"]].assign(norm=[round(float(np.sqrt((np.asarray(v, dtype=float) ** 2).sum())), 6) for v in pdf["embedding"]])

    return publish.map_batches_with_setup(s.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding"), setup, norms, "vec_id long, norm double")
