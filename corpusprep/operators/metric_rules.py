"""Rewriting of dotted metric names to metric names with labels by ordered patterns."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kind, pattern, metric name without its prefix, names of the captured parts in order.
# A pattern starting with "re:" is a regular expression searched in the name; in any other pattern each "*" stands
# for one part without dots and the pattern covers the whole name.
PREFIX = "af_agg_"
RULES = """
counter   re:(.+)\\.(.+)_start$                        job_start                            airflow_id job_name
counter   re:(.+)\\.(.+)_end$                          job_end                              airflow_id job_name
counter   re:(.+)\\.operator_failures_(.+)$            operator_failures                    airflow_id operator_name
counter   re:(.+)\\.operator_successes_(.+)$           operator_successes                   airflow_id operator_name
counter   *.ti_failures                               ti_failures                          airflow_id
counter   *.ti_successes                              ti_successes                         airflow_id
counter   *.zombies_killed                            zombies_killed                       airflow_id
counter   *.scheduler_heartbeat                       scheduler_heartbeat                  airflow_id
counter   *.dag_processing.processes                  dag_processing_processes             airflow_id
counter   *.scheduler.tasks.killed_externally         scheduler_tasks_killed_externally    airflow_id
counter   *.scheduler.tasks.running                   scheduler_tasks_running              airflow_id
counter   *.scheduler.tasks.starving                  scheduler_tasks_starving             airflow_id
counter   *.scheduler.orphaned_tasks.cleared          scheduler_orphaned_tasks_cleared     airflow_id
counter   *.scheduler.orphaned_tasks.adopted          scheduler_orphaned_tasks_adopted     airflow_id
counter   *.scheduler.critical_section_busy           scheduler_critical_section_busy      airflow_id
counter   *.sla_email_notification_failure            sla_email_notification_failure       airflow_id
counter   *.ti.start.*.*                              ti_start                             airflow_id dag_id task_id
counter   *.ti.finish.*.*.*                           ti_finish                            airflow_id dag_id task_id state
counter   *.dag.callback_exceptions                   dag_callback_exceptions              airflow_id
counter   *.celery.task_timeout_error                 celery_task_timeout_error            airflow_id
gauge     *.dagbag_size                               dagbag_size                          airflow_id
gauge     *.dag_processing.import_errors              dag_processing_import_errors         airflow_id
gauge     *.dag_processing.total_parse_time           dag_processing_total_parse_time      airflow_id
gauge     *.dag_processing.last_runtime.*             dag_processing_last_runtime          airflow_id dag_file
gauge     *.dag_processing.last_run.seconds_ago.*     dag_processing_last_run_seconds      airflow_id dag_file
gauge     *.dag_processing.processor_timeouts         dag_processing_processor_timeouts    airflow_id
gauge     *.executor.open_slots                       executor_open_slots                  airflow_id
gauge     *.executor.queued_tasks                     executor_queued_tasks                airflow_id
gauge     *.executor.running_tasks                    executor_running_tasks               airflow_id
gauge     *.pool.open_slots.*                         pool_open_slots                      airflow_id pool_name
gauge     *.pool.queued_slots.*                       pool_queued_slots                    airflow_id pool_name
gauge     *.pool.running_slots.*                      pool_running_slots                   airflow_id pool_name
gauge     *.pool.starving_tasks.*                     pool_starving_tasks                  airflow_id pool_name
gauge     *.smart_sensor_operator.poked_tasks         smart_sensor_operator_poked_tasks    airflow_id
gauge     *.smart_sensor_operator.poked_success       smart_sensor_operator_poked_success  airflow_id
gauge     *.smart_sensor_operator.poked_exception     smart_sensor_operator_poked_exception airflow_id
gauge     *.smart_sensor_operator.exception_failures  smart_sensor_operator_exception_failures airflow_id
gauge     *.smart_sensor_operator.infra_failures      smart_sensor_operator_infra_failures airflow_id
observer  *.dagrun.dependency-check.*                 dagrun_dependency_check              airflow_id dag_id
observer  *.dag.*.*.duration                          dag_task_duration                    airflow_id dag_id task_id
observer  *.dag_processing.last_duration.*            dag_processing_duration              airflow_id dag_file
observer  *.dagrun.duration.success.*                 dagrun_duration_success              airflow_id dag_id
observer  *.dagrun.duration.failed.*                  dagrun_duration_failed               airflow_id dag_id
observer  *.dagrun.schedule_delay.*                   dagrun_schedule_delay                airflow_id dag_id
observer  *.scheduler.critical_section_duration       scheduler_critical_section_duration  airflow_id
observer  *.dagrun.*.first_task_scheduling_delay      dagrun_first_task_scheduling_delay   airflow_id dag_id
"""


@dataclass(frozen=True)
class Rule:
    number: int
    kind: str
    pattern: str
    is_glob: bool
    metric: str
    labels: tuple[str, ...]


@cache
def parse_rules(text: str = RULES, prefix: str = PREFIX) -> tuple[Rule, ...]:
    rules = []
    for number, line in enumerate((line for line in text.splitlines() if line.strip()), start=1):
        kind, given, name, *labels = line.split()
        is_glob = not given.startswith("re:")
        pattern = "^" + re.escape(given).replace("\\*", "([^.]*)") + "$" if is_glob else given[3:]
        rules.append(Rule(number, kind, pattern, is_glob, prefix + name, tuple(labels)))
    return tuple(rules)


def rewrite_names(names: DataFrame, name: str = "name", kind: str = "kind", rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """Add ``rule_no, metric, labels`` to names; null where no rule matches.

    Whole-name patterns are tried before searched expressions, each in rule order; a rule only takes names of its
    kind. The rules are few and fixed, so they become one conditional expression: no join, no row per rule. Pass
    distinct names where a name repeats often.
    """
    ordered = sorted(rules or parse_rules(), key=lambda r: (not r.is_glob, r.number))
    first, *rest = ordered

    def hit(rule: Rule) -> Column:
        return (F.col(kind) == rule.kind) & F.col(name).rlike(rule.pattern)

    rule_no = F.when(hit(first), first.number)
    for rule in rest:
        rule_no = rule_no.when(hit(rule), rule.number)
    numbered = names.withColumn("rule_no", rule_no)

    def captured(rule: Rule) -> Column:
        parts = [(F.lit(label), F.regexp_extract(name, rule.pattern, i)) for i, label in enumerate(rule.labels, 1)]
        return F.create_map(*[item for pair in parts for item in pair])

    metric = F.when(F.col("rule_no") == first.number, first.metric)
    labels = F.when(F.col("rule_no") == first.number, captured(first))
    for rule in rest:
        metric = metric.when(F.col("rule_no") == rule.number, rule.metric)
        labels = labels.when(F.col("rule_no") == rule.number, captured(rule))
    return numbered.withColumn("metric", metric).withColumn("labels", labels)
