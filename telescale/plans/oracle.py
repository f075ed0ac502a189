"""The same results in plain SQL over the test tables, written in the literal form of each rule."""

from __future__ import annotations

from telescale.settings import REQUIRED_KEYS

_CTES = {
    "fx_events": """
        select user_id as app_id, event_id as seq, event_type as et, epoch_us(ts) // 1000 as t_ms, value,
               cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
        from events""",
    "fx_app": """
        select app_id, min(seq) as start_seq, arg_min(t_ms, seq) as app_start_ms,
               max(seq) as end_seq, arg_max(t_ms, seq) as app_end_ms
        from fx_events group by app_id""",
    "fx_points": """
        select app_id, seq, t_ms, case when et = 'signup' then 1 else -1 end as delta
        from fx_events where et in ('signup', 'error')""",
    "fx_jobs": """
        select app_id, cast(row_number() over (partition by app_id order by seq) - 1 as int) as job_id,
               seq as start_seq, t_ms as start_ms,
               lead(seq) over (partition by app_id order by seq) as end_seq,
               lead(t_ms) over (partition by app_id order by seq) as end_ms
        from fx_events where et = 'purchase'""",
    "fx_stages": """
        select app_id, job_id, seq as stage_id, seq as submit_seq, t_ms as submit_ms,
               t_ms + cast(floor(value * 3600000) as bigint) as complete_ms, k
        from (select *, cast(sum(case when et = 'purchase' then 1 else 0 end)
                             over (partition by app_id order by seq) - 1 as int) as job_id
              from fx_events) x
        where et = 'view'""",
    "fx_timeline": """
        select app_id, app_start_ms as t_ms, 0 as rank, start_seq as seq, 'app_start' as kind,
               null::int as job_id, null::bigint as stage_id, null::int as delta from fx_app
        union all select app_id, t_ms, 1, seq, 'executor', null, null, delta from fx_points
        union all select app_id, end_ms, 2, end_seq, 'job_end', job_id, null, null from fx_jobs
                  where end_seq is not null
        union all select app_id, start_ms, 3, start_seq, 'job_start', job_id, null, null from fx_jobs
        union all select app_id, submit_ms, 4, submit_seq, 'stage_submit', job_id, stage_id, null from fx_stages
        union all select app_id, complete_ms, 5, submit_seq, 'stage_complete', job_id, stage_id, null
                  from fx_stages
        union all select app_id, app_end_ms, 6, end_seq, 'app_end', null, null, null from fx_app""",
    "fx_counted": """
        select *, cast(greatest(0, 5 + coalesce(sum(delta) over w, 0)) as int) as alive
        from fx_timeline window w as (partition by app_id order by t_ms, rank, seq)""",
    "fx_tracked": """
        select *, last_value(upd ignore nulls) over (partition by app_id order by t_ms, rank, seq
                  rows between unbounded preceding and current row) as last_known
        from (select *, case when kind = 'app_start' then 5
                             when kind = 'job_end' or (kind = 'job_start' and job_id <> 0) then alive end as upd
              from fx_counted) x""",
    "fx_messages": """
        select app_id, t_ms, rank, seq, job_id, last_known,
               case kind when 'app_start' then 'APPLICATION_START' when 'app_end' then 'APPLICATION_END'
                         when 'job_start' then 'JOB_START' else 'JOB_END' end as event_type,
               case when kind = 'job_start' and job_id = 0 then 5
                    when kind = 'app_end' then last_known else alive end as num_executors
        from fx_tracked where kind in ('app_start', 'app_end', 'job_start', 'job_end')""",
    "fx_answered": """
        select m.*, r.recommended_scale_out
        from fx_messages m asof left join
             (select app_id, seq, k % 10 + 1 as recommended_scale_out from fx_events where et = 'click') r
             on m.app_id = r.app_id and m.seq >= r.seq""",
    "fx_effective": """
        select *, case when recommended_scale_out is not null then recommended_scale_out
                       when event_type <> 'APPLICATION_START' then num_executors end as effective_scale_out,
               case when recommended_scale_out is not null then 'answered'
                    when event_type = 'APPLICATION_START' then 'failed' else 'timeout' end as status
        from fx_answered""",
    "fx_candidates": """
        select * from fx_effective
        where event_type in ('JOB_START', 'JOB_END') and effective_scale_out <> last_known""",
    "fx_stage_events": """
        select s.app_id, s.job_id, s.stage_id, s.submit_ms, s.complete_ms, 'stage_submit' as kind
        from fx_stages s where s.job_id >= 0
        union all
        select s.app_id, s.job_id, s.stage_id, s.submit_ms, s.complete_ms, 'stage_complete'
        from fx_stages s join fx_jobs j on s.app_id = j.app_id and s.job_id = j.job_id
        where s.complete_ms <= j.end_ms""",
    "fx_counts": """
        select app_id, job_id, count(*) filter (kind = 'stage_submit') as submits,
               count(*) filter (kind = 'stage_complete') as completes
        from fx_stage_events group by app_id, job_id""",
    "fx_whole_jobs": """
        select j.* from fx_jobs j join fx_counts c on j.app_id = c.app_id and j.job_id = c.job_id
        where c.submits = c.completes and j.end_ms is not null""",
    "fx_intervals": """
        select app_id, seq, t_ms, coalesce(lead(t_ms) over w - t_ms, 0) as len
        from fx_points window w as (partition by app_id order by t_ms, seq)""",
    "fx_stage_windows": """
        select app_id, stage_id as id, submit_ms as s, complete_ms as e from fx_stages""",
    "fx_job_windows": """
        select j.app_id, j.job_id as id, a.app_start_ms as s, j.end_ms as e
        from fx_jobs j join fx_app a on j.app_id = a.app_id where j.end_ms is not null""",
    "fx_zero_windows": """
        select app_id, job_id as id, cast(0 as bigint) as s, end_ms as e from fx_jobs where end_ms is not null""",
    "fx_listings": """
        select distinct s.app_id, s.job_id, s.k % 10 as stage_id, j.start_seq as seq
        from fx_stages s join fx_jobs j on s.app_id = j.app_id and s.job_id = j.job_id""",
    "fx_clicked": """
        select app_id, seq, k % 10 as stage_id from fx_events where et = 'click'""",
    "fx_tasks": """
        select l_orderkey as job_id, l_linenumber as stage_id,
               cast(l_quantity as bigint) as run_ms, cast(round(l_extendedprice * 100) as bigint) as cpu_ns,
               l_suppkey % 5 as gc_ms, cast(round(l_tax * 100) as bigint) as shuffle_read,
               cast(round(l_discount * 100) as bigint) as shuffle_write,
               l_partkey as input_bytes, l_suppkey % 3 as output_bytes,
               l_partkey % 4 as disk_spill, cast(l_quantity as bigint) as peak_mem
        from lineitem""",
    "fx_rdds": """
        select l_orderkey as job_id, l_linenumber as stage_id, cast(l_quantity as bigint) as num_partitions,
               cast(l_linenumber as bigint) as num_cached_partitions,
               cast(round(l_extendedprice * 100) as bigint) as mem_size, l_partkey as disk_size
        from lineitem""",
    "fx_config": """
        select p_partkey as app_id, unnest([
          {key: 'spark.app.name', value: case when p_size % 4 = 0 then p_type
             else concat(p_type, ' with Params(', p_brand, ', ', cast(p_size as varchar), ')') end, ok: true},
          {key: 'spark.executor.memory', value: concat(p_size, 'G'), ok: true},
          {key: 'spark.executor.memoryOverhead', value: '2G', ok: p_size % 3 = 0},
          {key: 'spark.executor.cores', value: cast(p_size % 8 + 1 as varchar), ok: true},
          {key: 'spark.driver.cores', value: cast(p_size % 4 + 1 as varchar), ok: p_size % 7 <> 0},
          {key: 'spark.driver.memory', value: concat(p_size % 6 + 1, '.5g'), ok: true},
          {key: 'spark.dynamicAllocation.enabled', value: 'true', ok: p_size % 11 <> 0},
          {key: 'spark.customExtraListener.isAdaptive',
           value: case when p_size % 3 = 0 then 'true' else 'FALSE' end, ok: p_size % 3 <> 2},
          {key: 'spark.customExtraListener.isTraining', value: 'true', ok: p_size % 4 = 1},
          {key: 'spark.customExtraListener.bridgeServiceAddress', value: concat('tcp://', p_brand), ok: true},
          {key: 'spark.customExtraListener.datasizeMb', value: cast(p_retailprice / 1000 as varchar),
           ok: p_size % 5 <> 0},
          {key: 'spark.customExtraListener.targetRuntime', value: cast(p_size * 1000 as varchar),
           ok: p_size % 13 <> 0},
          {key: 'spark.customExtraListener.minExecutors', value: '2', ok: true},
          {key: 'spark.customExtraListener.maxExecutors',
           value: case when p_size % 19 = 0 then 'many' else cast(p_size % 10 + 2 as varchar) end, ok: true},
          {key: 'spark.customExtraListener.env.hadoopVersion', value: '3.3.4', ok: p_size % 17 <> 0},
          {key: 'spark.customExtraListener.env.sparkVersion', value: '3.5.3', ok: true},
          {key: 'spark.customExtraListener.env.scalaVersion', value: '2.12.18', ok: true},
          {key: 'spark.customExtraListener.env.javaVersion', value: concat('1.8.0_', p_size), ok: true}
        ], recursive := true)
        from part""",
    "fx_set": "select app_id, key, value from fx_config where ok",
    "fx_apps": "select p_partkey as app_id from part",
    "fx_host_disks": """
        select s_nationkey as host, cast(round(abs(s_acctbal) * 100) as bigint) * 1000000 as disk_bytes
        from supplier""",
    "fx_disk_gb": """
        select host, cast(sum(disk_bytes) as double) / (1024.0::double * 1024 * 1024) as disk_gb
        from fx_host_disks group by host""",
    "fx_machines": """
        select n_nationkey as host,
               concat('os:', regexp_replace(concat('OS ', n_name), '\\s+', '', 'g'),
                      '-cores:', n_nationkey % 16 + 1,
                      '-memory:', cast(cast(n_nationkey + 1 as bigint) * 1073741824 / (1024.0::double * 1024)
                                       as varchar),
                      '-disk_size:', cast(coalesce(disk_gb, 0.0::double) as varchar)) as machine_type
        from nation left join fx_disk_gb on n_nationkey = host""",
    "fx_typed": """
        select app_id, seq, case et when 'purchase' then 'JOB_START' when 'view' then 'JOB_END'
                 when 'signup' then 'APPLICATION_START' when 'error' then 'APPLICATION_END'
                 else 'CLICK' end as event_type
        from fx_events""",
    "fx_lines": """
        select *, row_number() over (partition by app_id order by at_ms, place, seq0) - 1 as seq from (
          select app_id, seq as seq0, t_ms as at_ms, 0 as place, et as what, null::int as job_id, t_ms, k, value
          from fx_events where et <> 'purchase'
          union all select app_id, stage_id, complete_ms, -1, 'completed', null, submit_ms, k, complete_ms
                    from fx_stages
          union all select app_id, start_seq, start_ms, 2, 'job_start', job_id, start_ms, null, null from fx_jobs
          union all select app_id, start_seq, end_ms, 1, 'job_end', job_id, end_ms, null, null from fx_jobs
                    where end_seq is not null
          union all select app_id, start_seq, app_start_ms, -5, 'log_start', null, null, null, null from fx_app
          union all select app_id, start_seq, app_start_ms, -4, 'environment', null, null, null, null from fx_app
          union all select app_id, start_seq, app_start_ms, -3, 'app_start', null, app_start_ms, null, null
                    from fx_app
          union all select a.app_id, a.start_seq, greatest(a.app_end_ms, max(s.complete_ms)), 9, 'app_end', null,
                    a.app_end_ms, null, null
                    from fx_app a left join fx_stages s on a.app_id = s.app_id
                    group by a.app_id, a.start_seq, a.app_end_ms) x""",
    "fx_timed": """
        select cast(app_id as varchar) as app_id, event_type, job_id, t_ms, num_executors, last_known,
               case when delay > 30000 then num_executors else job_id % 10 + 1 end as effective_scale_out,
               case when delay > 30000 then 'timeout' else 'answered' end as status
        from (select *, case when job_id % 7 = 3 then 99999 else job_id * 7 % 45 * 1000 end as delay from fx_messages
              where event_type in ('JOB_START', 'JOB_END')) x
        union all
        select cast(app_id as varchar), event_type, null, t_ms, num_executors, last_known, 5, 'answered'
        from fx_messages where event_type in ('APPLICATION_START', 'APPLICATION_END')""",
    "fx_numbered": """
        select app_id, job_id, k % 10 as stage_id, submit_seq as seq,
               cast(row_number() over (partition by app_id, job_id order by k % 10, submit_seq) as int) as position
        from fx_stages where job_id >= 0""",
}


def safe(a: str, b: str) -> str:
    return (
        f"case when ({a}) = 0 then 0.0::double when ({b}) = 0 then 1.0::double "
        f"else cast({a} as double) / cast({b} as double) end"
    )


def ratio(windows: str) -> str:
    """Pair each window with the intervals that touch it, drop the first and last, clip and sum."""
    return f"""
        select w.app_id, w.id, w.s, w.e, count(p.seq) as n, cast(coalesce(sum(
                 case when p.rn > 1 and p.rn < p.n then
                   greatest(p.s, least(p.e, case when p.len = 0 then p.e else p.t_ms + p.len end))
                   - least(greatest(p.s, p.t_ms), p.e) end), 0) as bigint) as ms
        from {windows} w left join (
          select w.app_id, w.id, w.s, w.e, i.seq, i.t_ms, i.len,
                 row_number() over (partition by w.app_id, w.id order by i.t_ms, i.seq) as rn,
                 count(*) over (partition by w.app_id, w.id) as n
          from {windows} w join fx_intervals i
            on w.app_id = i.app_id and i.t_ms + i.len >= w.s and i.t_ms <= w.e) p
          on w.app_id = p.app_id and w.id = p.id
        group by w.app_id, w.id, w.s, w.e"""


for _name, _windows in (("stage", "fx_stage_windows"), ("job", "fx_job_windows"), ("zero", "fx_zero_windows")):
    _CTES[f"fx_{_name}_ratio"] = ratio(_windows)

RATIO_COLUMNS = f"ms as rescaling_ms, {safe('ms', 'e - s')} as rescaling_time_ratio"


def setting(key: str) -> str:
    return f"(select c.value from fx_set c where c.app_id = a.app_id and c.key = '{key}')"


LISTENER = "spark.customExtraListener."


def algorithm(name: str) -> str:
    return f"""case when {name} like '% with Params(%' then trim(split_part({name}, 'with Params(', 1))
               else {name} end"""


def args(name: str) -> str:
    return f"""case when {name} like '% with Params(%'
               then replace(regexp_replace(split_part({name}, 'with Params(', 2), '\\)$', ''), ', ', '|')
               else '' end"""


def overhead(role: str) -> str:
    memory = setting(f"spark.{role}.memory")
    return f"""coalesce({setting(f"spark.{role}.memoryOverhead")},
               concat(cast(cast(regexp_replace({memory}, '[^0-9.]', '', 'g') as double) * 0.1::double as varchar),
                      regexp_replace({memory}, '[0-9.]', '', 'g')))"""


def datasize() -> str:
    return f"""cast(greatest(1, trunc(cast(coalesce({setting(LISTENER + 'datasizeMb')}, '1.0') as double)))
               as int)"""


def flag(key: str, default: str) -> str:
    return f"coalesce(lower({setting(key)}) = 'true', {default})"


def whole(key: str) -> str:
    return f"try_cast({setting(key)} as int)"


APP_SPECS = f"""
    {algorithm(setting('spark.app.name'))} as algorithm_name,
    {args(setting('spark.app.name'))} as algorithm_args, {datasize()} as datasize_mb,
    {whole(LISTENER + 'targetRuntime')} as target_runtime, {whole(LISTENER + 'minExecutors')} as min_executors,
    {whole(LISTENER + 'maxExecutors')} as max_executors"""

VERSIONS = f"""
    {setting(LISTENER + 'env.hadoopVersion')} as hadoop_version,
    {setting(LISTENER + 'env.sparkVersion')} as spark_version,
    {setting(LISTENER + 'env.scalaVersion')} as scala_version,
    {setting(LISTENER + 'env.javaVersion')} as java_version"""

FLAGS = f"""
    {flag(LISTENER + 'isAdaptive', 'true')} as is_adaptive,
    {flag(LISTENER + 'isTraining', 'false')} as is_training"""

METRICS = ", ".join([
    safe("cpu_ns", "run_ms * 1000000.0::double") + " as cpu_utilization",
    safe("gc_ms", "run_ms") + " as gc_time_ratio",
    safe("shuffle_read", "shuffle_write") + " as shuffle_read_write_ratio",
    safe("input_bytes", "output_bytes") + " as input_output_ratio",
    safe("disk_spill", "peak_mem") + " as memory_spill_ratio",
])
COUNTERS = ("cpu_ns", "run_ms", "gc_ms", "shuffle_read", "shuffle_write", "input_bytes", "output_bytes",
            "disk_spill", "peak_mem")


def task_totals(keys: str) -> str:
    sums = ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in COUNTERS)
    return f"select {keys}, {sums} from fx_tasks group by {keys}"


def rdd_totals(keys: str) -> str:
    return f"""
        select {keys}, cast(sum(num_partitions) as bigint) as rdd_num_partitions,
               cast(sum(num_cached_partitions) as bigint) as rdd_num_cached_partitions,
               cast(sum(mem_size) as bigint) as rdd_mem_size, cast(sum(disk_size) as bigint) as rdd_disk_size
        from fx_rdds group by {keys}"""


_CTES["fx_stage_metrics"] = f"select job_id as stage_id, {METRICS} from ({task_totals('job_id')}) t"
_CTES["fx_stage_rdds"] = f"select * from ({rdd_totals('job_id')}) r"
_CTES["fx_features"] = f"""
    select s.app_id, s.job_id, cast(s.stage_id as varchar) as stage_id, concat('view at ', s.stage_id) as stage_name,
           s.k as num_tasks, cast(s.stage_id - 1 as varchar) as parent_stage_ids, 0 as attempt_id,
           case when s.k % 13 = 0 then 'lost executor' else '' end as failure_reason,
           s.submit_ms as start_time, s.complete_ms as end_time, b.last_known as start_scale_out,
           f.last_known as end_scale_out, {safe('r.ms', 'r.e - r.s')} as stage_ratio,
           coalesce(rdd_num_partitions, 0) as rdd_num_partitions,
           coalesce(rdd_num_cached_partitions, 0) as rdd_num_cached_partitions,
           coalesce(rdd_mem_size, 0) as rdd_mem_size, coalesce(rdd_disk_size, 0) as rdd_disk_size,
           coalesce(cpu_utilization, 0) as cpu_utilization, coalesce(gc_time_ratio, 0) as gc_time_ratio,
           coalesce(shuffle_read_write_ratio, 0) as shuffle_read_write_ratio,
           coalesce(input_output_ratio, 0) as input_output_ratio,
           coalesce(memory_spill_ratio, 0) as memory_spill_ratio
    from fx_stages s
    join fx_whole_jobs j on s.app_id = j.app_id and s.job_id = j.job_id
    join fx_tracked b on b.app_id = s.app_id and b.stage_id = s.stage_id and b.kind = 'stage_submit'
    join fx_tracked f on f.app_id = s.app_id and f.stage_id = s.stage_id and f.kind = 'stage_complete'
    join fx_stage_ratio r on r.app_id = s.app_id and r.id = s.stage_id
    left join fx_stage_rdds d on d.job_id = s.stage_id
    left join fx_stage_metrics m on m.stage_id = s.stage_id"""
_CTES["fx_job_ends"] = f"""
    select m.app_id, m.job_id, m.t_ms as app_time, m.num_executors, {safe('r.ms', 'r.e - r.s')} as rescaling_time_ratio
    from fx_messages m join fx_job_ratio r on r.app_id = m.app_id and r.id = m.job_id
    where m.event_type = 'JOB_END'"""

LOG_TASK = """k % 10 as stage_id, 0 as attempt_id, seq0 as cpu_ns, k as run_ms, k % 5 as gc_ms,
    k % 4 + k % 6 as shuffle_read, 0 as shuffle_write, k % 8 as input_bytes, 0 as output_bytes,
    0 as disk_spill, 0 as peak_mem"""

MESSAGE = "app_id, event_type, job_id, t_ms, seq, num_executors, last_known"

_BODIES = {
    "app_start_records": f"""
        select cast(a.app_id as varchar) as application_id, {setting('spark.app.name')} as app_name,
               a.app_id * 1000 as app_time, {FLAGS}, {APP_SPECS},
               {whole('spark.driver.cores')} as driver_cores, {setting('spark.driver.memory')} as driver_memory,
               {overhead('driver')} as driver_memory_overhead,
               {whole('spark.executor.cores')} as executor_cores,
               {setting('spark.executor.memory')} as executor_memory,
               {overhead('executor')} as executor_memory_overhead,
               (select machine_type from fx_machines m where m.host = a.app_id % 25) as machine_type, {VERSIONS}
        from fx_apps a""",
    "job_start_records": """
        select app_id, job_id, t_ms as app_time, num_executors from fx_messages where event_type = 'JOB_START'""",
    "app_end_records": """
        select app_id, t_ms as app_time, num_executors from fx_messages where event_type = 'APPLICATION_END'""",
    "missing_required_config": f"""
        select a.app_id, r.key from (select app_id from fx_apps union select -1 - app_id from fx_apps) a
        cross join (select unnest([{', '.join(repr(k) for k in REQUIRED_KEYS)}]) as key) r
        where not exists (select 1 from fx_set c where c.app_id = a.app_id and c.key = r.key)""",
    "non_driver_executors": """
        select app_id, seq, concat('host-', k % 10, ':', 7000 + k) as address
        from fx_events where et = 'signup' and k % 10 <> app_id % 10""",
    "invalid_responses": """
        select case k % 10 when 3 then 'timeout' when 4 then concat('{"app_event_id":"', app_id, '"}')
                 else concat('{"app_event_id":"', app_id, '","recommended_scale_out":"x"}') end as value,
               case k % 10 when 3 then 'not json' else 'missing field' end as reason
        from fx_events where et = 'click' and k % 10 in (3, 4, 5)""",
    "event_type_filter": "select * from fx_typed where event_type <> 'CLICK'",
    "illegal_event_types": "select * from fx_typed where event_type = 'CLICK'",
    "incomplete_stage_events": """
        select app_id, stage_id, 'stage_submit' as kind, null::bigint as submit_ms,
               case when k % 7 <> 0 then complete_ms end as complete_ms from fx_stages where k % 11 = 0
        union all
        select app_id, stage_id, 'stage_complete', case when k % 11 <> 0 then submit_ms end, null
        from fx_stages where k % 7 = 0""",
    "adaptive_training_flags": f"select a.app_id, {FLAGS} from fx_apps a",
    "scale_change_candidates": f"select {MESSAGE}, effective_scale_out from fx_candidates",
    "stage_job_mapping": """
        select c.app_id, c.seq, c.stage_id, arg_max(l.job_id, l.seq) as job_id
        from fx_clicked c left join fx_listings l
          on c.app_id = l.app_id and c.stage_id = l.stage_id and l.seq <= c.seq
        group by c.app_id, c.seq, c.stage_id""",
    "last_known_asof": """
        select app_id, stage_id, kind, t_ms, last_known from fx_tracked
        where kind in ('stage_submit', 'stage_complete')""",
    "stage_pairing": """
        with p as (select *, cast(row_number() over (partition by app_id, job_id, kind order by stage_id) as int)
                             as position from fx_stage_events)
        select s.app_id, s.job_id, s.position, s.stage_id as submit_stage_id, c.stage_id as complete_stage_id
        from p s join p c on s.app_id = c.app_id and s.job_id = c.job_id and s.position = c.position
        where s.kind = 'stage_submit' and c.kind = 'stage_complete'""",
    "stage_rescaling_ratio": f"select app_id, id as stage_id, {RATIO_COLUMNS} from fx_stage_ratio",
    "response_match": f"select {MESSAGE}, recommended_scale_out from fx_answered",
    "orphan_stages": """
        select * from fx_clicked c where not exists (
          select 1 from fx_listings l
          where l.app_id = c.app_id and l.stage_id = c.stage_id and l.seq <= c.seq)""",
    "jobs_without_stages": """
        select o_orderkey as job_id from orders
        where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "app_config_lookup": f"""
        select a.app_id, l_orderkey as job_id, l_linenumber, a.executor_memory, a.target_runtime
        from lineitem join (
          select a.app_id, {setting('spark.executor.memory')} as executor_memory,
                 {setting(LISTENER + 'targetRuntime')} as target_runtime from fx_apps a) a
          on l_partkey = a.app_id""",
    "alive_executor_count": """
        select app_id, seq, t_ms, delta, cast(greatest(0, 5 + (
          select sum(q.delta) from fx_points q where q.app_id = p.app_id and q.seq <= p.seq)) as int) as scale_out
        from fx_points p""",
    "stage_task_totals": task_totals("job_id, stage_id"),
    "stage_metric_ratios": f"select job_id, stage_id, {METRICS} from ({task_totals('job_id, stage_id')}) t",
    "stage_rdd_totals": rdd_totals("job_id, stage_id"),
    "job_rescaling_ratio": f"select app_id, id as job_id, {RATIO_COLUMNS} from fx_job_ratio",
    "job_rescaling_ratio_from_zero": f"select app_id, id as job_id, {RATIO_COLUMNS} from fx_zero_ratio",
    "stage_features": """
        select * exclude (stage_ratio), stage_ratio as rescaling_time_ratio from fx_features""",
    "job_end_records": """
        select j.app_time, j.num_executors, j.rescaling_time_ratio, f.* exclude (stage_ratio),
               f.stage_ratio as stage_rescaling_time_ratio
        from fx_job_ends j join fx_features f on f.app_id = j.app_id and f.job_id = j.job_id""",
    "stage_count_mismatch": "select * from fx_counts where submits <> completes",
    "effective_recommendation": f"select {MESSAGE}, effective_scale_out, status from fx_effective",
    "latest_attempt_per_stage": """
        select * from fx_numbered n where position = (
          select max(m.position) from fx_numbered m
          where m.app_id = n.app_id and m.job_id = n.job_id and m.stage_id = n.stage_id)""",
    "host_disk_total": "select * from fx_disk_gb",
    "scale_out_intervals": """
        select i.app_id, i.seq, i.t_ms, p.delta, i.len as interval_ms, cast(greatest(0, 5 + (
          select sum(q.delta) from fx_points q where q.app_id = i.app_id and q.seq <= i.seq)) as int) as scale_out
        from fx_intervals i join fx_points p on i.app_id = p.app_id and i.seq = p.seq""",
    "interior_intervals": """
        select app_id, id as stage_id, n as n_overlapping, greatest(0, n - 2) as n_interior from fx_stage_ratio""",
    "last_known_timeline": """
        select app_id, seq, kind, t_ms, last_known from fx_tracked where upd is not null""",
    "stage_order_in_job": "select * from fx_numbered",
    "scale_decisions": """
        select app_id, event_type, job_id, t_ms, effective_scale_out, waited_ms,
               case when waited_ms < 15000 then 'suppressed' else 'requested' end as decision
        from (select c.*, c.t_ms - coalesce(lag(c.t_ms) over (
                partition by c.app_id order by c.t_ms, c.rank, c.seq), a.app_start_ms) as waited_ms
              from fx_candidates c join fx_app a on a.app_id = c.app_id) x""",
    "initial_scale_requests": """
        select app_id, t_ms, effective_scale_out, 'initial' as decision from fx_effective
        where event_type = 'APPLICATION_START' and status = 'answered'""",
    "safe_ratio": f"""
        select job_id, stage_id, shuffle_read, shuffle_write, {safe('shuffle_read', 'shuffle_write')} as ratio
        from fx_tasks""",
    "algorithm_and_args": """
        select p_partkey as app_id, p_type as algorithm_name,
               case when p_size % 4 = 0 then '' else concat(p_brand, '|', p_size) end as algorithm_args,
               case when p_size % 4 = 0 then 0 else 2 end as n_args
        from part""",
    "datasize_mb": f"select a.app_id, {datasize()} as datasize_mb from fx_apps a",
    "memory_overhead": f"select a.app_id, {overhead('executor')} as memory_overhead from fx_apps a",
    "app_specs": f"select a.app_id, {APP_SPECS} from fx_apps a",
    "node_specs": " union all ".join(
        f"""select a.app_id, '{r}' as role, {whole(f'spark.{r}.cores')} as cores,
                   {setting(f'spark.{r}.memory')} as memory, {overhead(r)} as memory_overhead from fx_apps a"""
        for r in ("driver", "executor")
    ),
    "unreadable_settings": f"""
        select app_id, key, value from fx_set where key = '{LISTENER}maxExecutors' and value = 'many'""",
    "machine_type": "select * from fx_machines",
    "interval_clip": """
        select i.app_id, i.seq,
               greatest(s, least(e, case when len = 0 then e else t_ms + len end)) - least(greatest(s, t_ms), e)
                 as clipped_ms
        from fx_intervals i join (select app_id, app_start_ms + 864000000 as s, app_start_ms + 1728000000 as e
                                  from fx_app) a on i.app_id = a.app_id""",
    "failure_reason_default": """
        select app_id, seq as stage_id, case when k % 13 = 0 then 'lost executor' else '' end as failure_reason
        from fx_events where et = 'view'""",
    "stage_id_text": "select app_id, cast(seq as varchar) as stage_id from fx_events where et = 'view'",
    "environment_versions": f"select a.app_id, {VERSIONS} from fx_apps a",
    "scan_app_events": """
        select cast(app_id as varchar) as app_id, seq, what as kind, t_ms,
               case when what = 'app_start' then concat('app ', app_id) end as app_name
        from fx_lines where what in ('app_start', 'app_end')""",
    "scan_job_events": """
        select cast(app_id as varchar) as app_id, seq, what as kind, job_id, t_ms,
               case when what = 'job_start' then coalesce((
                 select string_agg(cast(s.stage_id as varchar), ',' order by s.stage_id) from fx_stages s
                 where s.app_id = l.app_id and s.job_id = l.job_id), '') end as stage_ids,
               case when what = 'job_end' then 'JobSucceeded' end as result
        from fx_lines l where what in ('job_start', 'job_end')""",
    "scan_stage_events": """
        select cast(app_id as varchar) as app_id, seq,
               case when what = 'view' then 'stage_submit' else 'stage_complete' end as kind,
               seq0 as stage_id, 0 as attempt_id, concat('view at ', seq0) as stage_name, k as num_tasks,
               cast(seq0 - 1 as varchar) as parent_stage_ids, t_ms as submit_ms,
               case when what = 'completed' then cast(value as bigint) end as complete_ms,
               case when what = 'completed' and k % 13 = 0 then 'lost executor' end as failure_reason,
               case when what = 'completed' then k else 0 end as rdd_num_partitions,
               case when what = 'completed' then k % 3 else 0 end as rdd_num_cached_partitions,
               case when what = 'completed' then k * 10 else 0 end as rdd_mem_size,
               case when what = 'completed' then k * 20 else 0 end as rdd_disk_size
        from fx_lines where what in ('view', 'completed')""",
    "scan_executor_events": """
        select cast(app_id as varchar) as app_id, seq, t_ms, cast(k as varchar) as executor_id,
               case when what = 'signup' then concat('host-', k % 10) end as host,
               case when what = 'signup' then 1 else -1 end as delta
        from fx_lines where what in ('signup', 'error')""",
    "scan_task_metrics": f"select cast(app_id as varchar) as app_id, seq, {LOG_TASK} from fx_lines where what = 'click'",
    "scan_task_totals": f"""
        select cast(app_id as varchar) as app_id, stage_id, attempt_id,
               {', '.join(f'cast(sum({c}) as bigint) as {c}' for c in COUNTERS)}
        from (select app_id, {LOG_TASK} from fx_lines where what = 'click') t group by all""",
    "scan_app_config": """
        select cast(app_id as varchar) as app_id, 'spark.app.name' as key, concat('app ', app_id) as value from fx_app
        union all select cast(app_id as varchar), 'spark.executor.cores', cast(app_id % 8 + 1 as varchar) from fx_app""",
    "stream_events": """
        select cast(app_id as varchar) as app_id, seq, case what when 'job_start' then 'JobStart'
                 when 'job_end' then 'JobEnd' when 'app_start' then 'ApplicationStart'
                 when 'app_end' then 'ApplicationEnd' when 'view' then 'StageSubmitted'
                 when 'completed' then 'StageCompleted' when 'signup' then 'ExecutorAdded'
                 when 'error' then 'ExecutorRemoved' when 'click' then 'TaskEnd'
                 when 'log_start' then 'LogStart' else 'EnvironmentUpdate' end as event
        from fx_lines""",
    "stream_app_state": """
        select cast(app_id as varchar) as app_id, kind, t_ms, job_id, num_executors, last_known from (
          select app_id, kind, t_ms, job_id, last_known,
                 case when kind = 'job_start' and job_id = 0 then 5 when kind = 'app_end' then last_known
                      else alive end as num_executors
          from fx_tracked where kind in ('app_start', 'app_end', 'job_start', 'job_end')) x
        union all
        select cast(t.app_id as varchar), t.kind, t.t_ms, null, t.alive, t.last_known
        from fx_tracked t where t.kind in ('executor', 'stage_submit', 'stage_complete')""",
    "stream_stage_pairs": """
        select cast(app_id as varchar) as app_id, stage_id, 0 as attempt_id, submit_ms, complete_ms
        from fx_stages""",
    "stream_job_end": """
        select cast(j.app_id as varchar) as app_id, j.job_id, j.app_time, j.num_executors,
               j.rescaling_time_ratio, cast(f.stage_id as int) as stage_id, f.stage_name, f.num_tasks,
               f.parent_stage_ids, f.attempt_id, f.failure_reason, f.start_time as submit_ms,
               f.end_time as complete_ms, f.start_scale_out, f.end_scale_out,
               f.stage_ratio as stage_rescaling_time_ratio, f.num_tasks as rdd_num_partitions,
               f.num_tasks * 20 as rdd_disk_size
        from fx_job_ends j join fx_features f on f.app_id = j.app_id and f.job_id = j.job_id""",
    "stream_response_timeout": "select * from fx_timed",
    "stream_scale_decisions": """
        select app_id, event_type, job_id, t_ms, effective_scale_out, waited_ms,
               case when waited_ms < 15000 then 'suppressed' else 'requested' end as decision
        from (select c.app_id, c.event_type, c.job_id, c.t_ms, c.effective_scale_out,
                     c.t_ms - coalesce(lag(c.t_ms) over (
                       partition by c.app_id order by c.t_ms, c.event_type, c.job_id), a.app_start_ms) as waited_ms
              from fx_timed c join fx_app a on cast(a.app_id as varchar) = c.app_id
              where c.event_type in ('JOB_START', 'JOB_END') and c.effective_scale_out <> c.last_known) x""",
    "scan_recommendations": """
        select cast(app_id as varchar) as app_event_id, k % 10 + 1 as recommended_scale_out
        from fx_events where et = 'click' and k % 10 not in (3, 4, 5)""",
    "sink_messages": """
        select event_type, event_type as tag, cast(app_id as varchar) as app_event_id, t_ms as app_time, job_id,
               num_executors, null::double as rescaling_time_ratio, null::int as n_stages, null::bigint as n_tasks,
               null as application_id, null as app_name, null as driver_memory, null as machine_type
        from fx_messages where event_type in ('JOB_START', 'APPLICATION_END')
        union all
        select 'JOB_END', 'JOB_END', cast(j.app_id as varchar), j.app_time, j.job_id, j.num_executors,
               j.rescaling_time_ratio, cast(count(*) as int), cast(sum(f.num_tasks) as bigint), null, null, null, null
        from fx_job_ends j join fx_features f on f.app_id = j.app_id and f.job_id = j.job_id
        group by all
        union all
        select 'APPLICATION_START', 'APPLICATION_START', null, app_time, null, null, null, null, null,
               application_id, app_name, driver_memory, machine_type from fx_app_starts""",
}


def _with(body: str, ctes: dict[str, str]) -> str:
    """Put the definitions a query uses in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in ctes:
            if name in text and name not in needed:
                needed.add(name)
                visit(ctes[name])

    visit(body)
    head = ",\n".join(f"{n} as ({sql})" for n, sql in _ordered(needed, ctes))
    if body.lstrip().lower().startswith("with "):
        return f"with {head},\n{body.lstrip()[5:]}"
    return f"with {head}\n{body}" if head else body


def _ordered(needed: set[str], ctes: dict[str, str]):
    done: list[str] = []

    def place(name: str) -> None:
        if name in done:
            return
        for other in ctes:
            if other != name and other in needed and other in ctes[name]:
                place(other)
        done.append(name)

    for name in ctes:
        if name in needed:
            place(name)
    return [(n, ctes[n]) for n in done]


_BODIES["scan_versions"] = """
    select cast(app_id as varchar) as app_id, '4.1.2' as spark_version, null::varchar as java_version,
           null::varchar as scala_version from fx_app"""
_BODIES["stream_messages"] = _BODIES["sink_messages"].replace(
    "application_id, app_name, driver_memory, machine_type from fx_app_starts",
    "cast(app_id as varchar), concat('app ', app_id), null, null from fx_app",
).replace("'APPLICATION_START', null, app_time,", "'APPLICATION_START', null, app_start_ms,")
_BODIES["stream_answers"] = """
        select cast(app_id as varchar) as app_id, event_type, job_id,
               t_ms + coalesce(job_id * 7 % 45 * 1000, 0) as answered_ms, coalesce(job_id % 10 + 1, 5) as recommended_scale_out
        from fx_messages where job_id is null or job_id % 7 <> 3"""
_BODIES["stream_rejects"] = """
        select case when job_id % 10 = 0 then 'timeout' else concat('{"app_event_id":"', app_id, '"}') end as value,
               case when job_id % 10 = 0 then 'not json' else 'missing field' end as reason
        from fx_messages where event_type = 'JOB_END' and job_id % 5 = 0"""
_BODIES["stream_late_rows"] = """
        select cast(app_id as varchar) as app_id, count(*) as n_rows, 0 as n_late
        from fx_lines where what not in ('click', 'log_start') group by app_id"""
_BODIES["fleet_job_end_rows"] = _BODIES["stream_job_end"]
_BODIES["fleet_job_start"] = f"select * replace (cast(app_id as varchar) as app_id) from ({_BODIES['job_start_records']})"
_BODIES["answers_to_decisions"] = _BODIES["scale_decisions"]
_CTES["fx_app_starts"] = _BODIES["app_start_records"]
ORACLE = {name: _with(body, _CTES) for name, body in _BODIES.items()}
