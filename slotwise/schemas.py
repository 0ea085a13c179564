"""Explicit schemas of the pool records."""

# DDL of the JSON records; missing fields read as NULL.
ANNOTATION = (
    "struct<instance_id:string,class_id:int,class_name:string,bbox:array<int>,normalized_bbox:array<double>,"
    "visible_bbox_fraction:double,source_asset:string,source_group:string,object_attempt:int,sampled_scale:double,"
    "sampled_rotation_degrees:double,requested_objects:int,region:string>"
)
OBJECT_REJECTION = (
    "struct<schema_version:int,slot:bigint,candidate_attempt:int,object_attempt:int,asset:string,class_name:string,"
    "`group`:string,scale:double,rotation_degrees:double,requested_objects:int,stage:string,reason:string,"
    "placement_attempts:int,blocking_counts:map<string,bigint>,clipped_sides:array<string>,region:string,"
    "projected_bbox:array<double>,clipped_bbox:array<int>,visibility:double>"
)
BACKGROUND = (
    "struct<recipe_id:string,graph_hash:string,sources:array<struct<node:string,logical_path:string,content_hash:string,"
    "perceptual_hash:string,`group`:string,reused:boolean>>,node_timings_ns:map<string,bigint>,qa:map<string,string>,"
    "warnings:array<string>>"
)
SAMPLE = (
    "schema_version int, slot bigint, candidate_attempt int, sample_id string, image_path string, "
    "geometry_signature string, intentional_negative boolean, attempted_instances int, "
    f"annotations array<{ANNOTATION}>, rejected_instances array<{OBJECT_REJECTION}>, background {BACKGROUND}, "
    "stage_timings_ns map<string,bigint>, mask_evidence struct<format:string,sha256:string,byte_count:bigint,path:string,"
    "image_size:array<int>,alpha_threshold:int>"
)
REJECTION = (
    "schema_version int, slot bigint, candidate_attempt int, reason string, message string, stage_timings_ns map<string,bigint>"
)
METRIC = (
    "metric_type string, session_id string, sequence bigint, elapsed_seconds double, run_state string, "
    "cpu_percent double, rss_bytes bigint, sample_errors int, code string, dropped_samples bigint, ingested_at timestamp"
)
CONTROL_EVENT = "run string, event string, sequence bigint, timestamp timestamp, actual_state string, desired_state string, actor string"
RUN = (
    "schema_version int, run_id string, contract_hash string, catalog_fingerprint string, "
    "family struct<classes:array<string>>, profile struct<run:struct<num_images:int>,output:struct<image_size:array<int>>>"
)
OBSERVATION = (
    "schema_version int, kind string, performance_fingerprint string, family string, workers int, "
    "environment_class string, active_seconds double, candidate_attempts bigint, accepted_samples bigint, "
    "seconds_per_candidate double, duration_seconds double"
)
