"""The given tables seen as the tables of this package. `SQL` restates them for the oracle."""

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_path

CUT = "2024-01-16 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tenant(key: Column) -> Column:
    return F.concat(F.lit("t"), (key % 3).cast("string"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change records."""
    events = table(spark, sf_dir, "events")
    return events.select(
        tenant(F.col("user_id")).alias("tenant_code"), F.lit(2024).alias("api_year"), F.lit("resources").alias("kind"),
        F.col("event_type").alias("name"), F.col("event_id").alias("change_version"), F.col("props").alias("payload"), "ts",
    )


def paged_feed(spark: SparkSession, sf_dir: str) -> str:
    """The feed as the store of a paged source: a folder for each stream in the shared scratch folder, sorted by version.

    Small row groups with their least and greatest versions let a page be read without the rows around it.
    """
    path = scratch_path(spark, "paged-feed")
    rows = feed(spark, sf_dir).select("change_version", "payload", "tenant_code", "name")
    order = ["tenant_code", "name", "change_version"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.size", 1 << 16).partitionBy("tenant_code", "name").parquet(path)
    return path


class FeedClient:
    """The feed as a paged source, read in the tasks from a store of `paged_feed`. Each page fails the first time that it is
    asked for."""

    def __init__(self, store: str, upto: int | None = None):
        self.store, self.upto, self.asked = store, upto, None
        self.streams, self.groups, self.ends = {}, {}, {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "streams": {}, "groups": {}, "ends": {}}

    def _stream(self, piece: dict) -> tuple[tuple, list, list, list]:
        """A stream, its files, their row groups in the order of versions, and the rows up to the end of each."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        key = piece["tenant_code"], piece["name"]
        if key not in self.streams:
            system, root = fs.FileSystem.from_uri(self.store) if ":/" in self.store else (fs.LocalFileSystem(), self.store)
            found = system.get_file_info(fs.FileSelector(f"{root}/tenant_code={key[0]}/name={key[1]}", allow_not_found=True))
            files = [pq.ParquetFile(info.path, filesystem=system) for info in found if info.base_name.endswith(".parquet")]
            groups = []
            for number, file in enumerate(files):
                for group in range(file.metadata.num_row_groups):
                    part = file.metadata.row_group(group)
                    groups.append((part.column(0).statistics.min, part.column(0).statistics.max, number, group, part.num_rows))
            groups.sort()
            self.streams[key] = files, groups, list(accumulate(group[-1] for group in groups))
        return key, *self.streams[key]

    def _rows(self, piece: dict, index: int):
        """Rows of a row group; the last few are kept."""
        key, files, groups, _ = self._stream(piece)
        if (key, index) not in self.groups:
            if len(self.groups) >= 4:
                del self.groups[next(iter(self.groups))]
            self.groups[key, index] = files[groups[index][2]].read_row_group(groups[index][3])
        return self.groups[key, index]

    def _below(self, piece: dict, version: int) -> int:
        """Rows of a stream before a version."""
        _, _, groups, ends = self._stream(piece)
        index = bisect_left(groups, version, key=lambda group: group[1])
        if index == len(groups) or version <= groups[index][0]:
            return ends[index - 1] if index else 0
        versions = self._rows(piece, index)["change_version"].to_numpy()
        return ends[index] - groups[index][-1] + int(versions.searchsorted(version))

    def _ends(self, piece: dict) -> tuple[int, int]:
        """The rows of a piece as positions in its stream."""
        low, high = piece.get("slice_min"), piece.get("slice_max")
        key, _, _, ends = self._stream(piece)
        if self.ends.get("of") != (key, low, high):
            tops = [end for end in (high, self.upto) if end is not None]
            stop = self._below(piece, min(tops) + 1) if tops else (ends[-1] if ends else 0)
            self.ends = {"of": (key, low, high), "at": (0 if low is None else self._below(piece, low), stop)}
        return self.ends["at"]

    def fetch(self, piece: dict, offset: int, page_size: int) -> list[tuple[int, str]]:
        page = (piece["tenant_code"], piece["name"], piece.get("slice_min"), offset)
        if page != self.asked:
            self.asked = page
            raise OSError("busy")
        self.asked = None
        start, stop = self._ends(piece)
        at, stop = start + offset, min(start + offset + page_size, stop)
        *_, groups, ends = self._stream(piece)
        rows = []
        while at < stop:
            index = bisect_right(ends, at)
            first = ends[index] - groups[index][-1]
            some = self._rows(piece, index).slice(at - first, stop - at)
            rows += zip(some["change_version"].to_pylist(), some["payload"].to_pylist())
            at += len(some)
        return rows

    def texts(self, piece: dict, offset: int, page_size: int) -> list[str]:
        return [text for _, text in self.fetch(piece, offset, page_size)]

    def newest(self, piece: dict) -> int | None:
        _, stop = self._ends(piece)
        if stop == 0:
            return None
        *_, groups, ends = self._stream(piece)
        index = bisect_left(ends, stop)
        return self._rows(piece, index)["change_version"][stop - 1 - ends[index] + groups[index][-1]].as_py()


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early events as marks, with all values of the flags."""
    events = table(spark, sf_dir, "events").filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    key = F.col("event_id")
    deletes = F.when(key % 3 == 0, F.lit(None)).when(key % 3 == 1, False).otherwise(True)
    return events.select(
        F.col("event_type").alias("name"), F.to_date("ts").alias("pull_date"),
        F.col("ts").cast("timestamp").alias("pull_timestamp"), key.alias("max_version"),
        (key % 7 != 0).alias("is_active"), deletes.alias("is_deletes"), (key % 11 == 0).alias("is_key_changes"),
        tenant(F.col("user_id")).alias("tenant_code"), F.lit(2024).alias("api_year"),
    )


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenant, year and name of the feed, with the newest version of each."""
    return feed(spark, sf_dir).groupBy("tenant_code", "api_year", "name").agg(
        F.max("change_version").alias("endpoint_version")
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log records; a run is a tenant's day."""
    events = table(spark, sf_dir, "events")
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    message = F.when(F.col("event_type") == "signup", F.concat(F.lit("saw ERROR "), "event_id")).otherwise(
        F.concat("event_type", F.lit(" "), "event_id")
    )
    return events.select(
        tenant(F.col("user_id")).alias("tenant_code"), F.lit(2024).alias("api_year"),
        F.lit(None).cast("string").alias("grain_update"), F.lit("nightly").alias("run_type"),
        F.to_date("ts").alias("run_date"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("run_timestamp"),
        F.col("event_id").alias("seq"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit("task").alias("name"), level.alias("level"), message.alias("message"), F.lit("run.py").alias("pathname"),
        (F.col("event_id") % 97).cast("int").alias("lineno"),
        F.create_map(F.lit("0"), F.col("props")).alias("args"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("kwargs"),
    )


def sent_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as payloads sent before; toxic ones failed with a server error."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return docs.select(
        F.col("source").alias("endpoint"), F.sha2("text", 256).alias("payload_hash"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("quality")).cast("timestamp").alias("sent_at"),
        F.when(F.col("toxic") == 1, 500).otherwise(201).alias("status_code"),
    )


def organisations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Suppliers as connections; the parts they sell as their schools, those returned as the calendars' schools."""
    suppliers = table(spark, sf_dir, "supplier")
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    prefix = F.when(key % 13 == 12, "other").otherwise("edfi")
    connections = suppliers.select(
        F.concat(prefix, F.lit("_n_"), nation.cast("string"), F.lit("_2024_"), key.cast("string")).alias("connection_id"),
        F.when(key % 17 == 16, "connection refused").alias("error"), "s_suppkey", "s_nationkey",
    )
    lea, agency = F.lit("edfi.LocalEducationAgency"), F.concat(F.lit("L"), nation.cast("string"))

    def org(kind: Column, value: Column) -> Column:
        return F.struct(kind.alias("type"), value.alias("local_education_agency_id"))

    orgs = (
        F.when(key % 6 == 0, F.array(org(lea, agency), org(F.lit("edfi.School"), F.lit("S1"))))
        .when(key % 6 == 1, F.array(org(lea, F.lit("L_other"))))
        .when(key % 6 == 2, F.array(org(lea, agency), org(lea, F.lit("L_other"))))
        .otherwise(F.array(org(lea, F.lit(None).cast("string"))))
    )
    token_orgs = connections.select("connection_id", orgs.alias("orgs"))
    leas = connections.filter(key % 6 == 3).select(
        "connection_id", F.parse_json(F.to_json(F.struct(agency.alias("localEducationAgencyId")))).alias("v")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag")
    listed = lines.join(connections.filter(key % 6 >= 4), F.col("l_suppkey") == key)
    school = F.struct(
        F.col("l_partkey").alias("schoolId"),
        F.struct(
            F.when((key % 6 == 4) | (F.col("l_partkey") % 2 == 0), agency).otherwise(F.lit("L_other")).alias("localEducationAgencyId")
        ).alias("localEducationAgencyReference"),
    )
    schools = listed.select("connection_id", F.parse_json(F.to_json(school)).alias("v"))
    calendar = F.struct(F.struct(F.col("l_partkey").alias("schoolId")).alias("schoolReference"))
    calendars = listed.filter((F.col("l_returnflag") == "R") & (key % 12 != 10)).select(
        "connection_id", F.parse_json(F.to_json(calendar)).alias("v")
    )
    nations = table(spark, sf_dir, "nation")
    mapping = nations.filter("n_nationkey <> 7").select(
        F.concat(F.lit("n_"), F.col("n_nationkey").cast("string")).alias("tenant"),
        F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("expected_lea_id"),
    )
    return {
        "connections": connections.select("connection_id", "error"), "token_orgs": token_orgs, "leas": leas,
        "calendars": calendars, "schools": schools, "mapping": mapping,
    }


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")


def source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of an assessment file, one assessment per priority."""
    return table(spark, sf_dir, "orders").select(
        F.lit("t0").alias("tenant_code"), F.year("o_orderdate").alias("api_year"),
        F.col("o_orderpriority").alias("assessment_name"), "o_custkey", "o_orderkey",
    )


# The same views for the oracle. `{...}` is replaced by the text of another view.
SQL = {
    "feed": """
feed as (select 't'||cast(user_id%3 as varchar) tenant_code, 2024 api_year, 'resources' kind, event_type as name,
         event_id change_version, props payload, ts from events)""",
    "ledger": """
ledger as (select event_type as name, cast(ts as date) pull_date, ts pull_timestamp, event_id max_version,
           event_id%7<>0 is_active,
           case event_id%3 when 0 then null when 1 then false else true end is_deletes,
           event_id%11=0 is_key_changes, 't'||cast(user_id%3 as varchar) tenant_code, 2024 api_year
           from events where ts < timestamp '2024-01-16 00:00:00')""",
    "endpoints": """
endpoints as (select tenant_code, api_year, name, max(change_version) endpoint_version from feed group by all)""",
    "live": """
live as (select tenant_code, api_year, name, max(max_version) mv from ledger
         where is_active and not coalesce(is_deletes,false) and not coalesce(is_key_changes,false) group by all)""",
    "windows": """
windows as (select e.tenant_code, e.api_year, e.name, coalesce(mv,0) last_version,
            (select max(change_version) from feed) newest_version
            from endpoints e left join live using (tenant_code, api_year, name))""",
    "logs": """
logs as (select 't'||cast(user_id%3 as varchar) tenant_code, cast(ts as date) run_date, event_id seq,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') as timestamp,
         case when event_type='error' then 'ERROR' else 'INFO' end as level,
         case when event_type='signup' then 'saw ERROR '||event_id else event_type||' '||event_id end as message,
         event_id%97 lineno, props, user_id from events)""",
    "errors": """
errors as (select * from logs where level='ERROR' or contains(message,'ERROR'))""",
    "rates": """
src as (select 't0' tenant_code, year(o_orderdate) api_year, o_orderpriority assessment_name, o_custkey, o_orderkey from orders),
ros as (select c_custkey, c_nationkey from customer),
sids as (select tenant_code, api_year, assessment_name, 'o_custkey' source_column_name, cast(o_custkey as varchar) id from src
   union all select tenant_code, api_year, assessment_name, 'o_orderkey', cast(o_orderkey as varchar) from src),
rids as (select distinct 'c_custkey' edfi_column_name, cast(c_custkey as varchar) id from ros
   union select distinct 'c_nationkey', cast(c_nationkey as varchar) from ros),
cols as (select distinct edfi_column_name from (values ('c_custkey'),('c_nationkey')) t(edfi_column_name)),
rates as (select s.tenant_code, cast(s.api_year as integer) api_year, s.assessment_name, s.source_column_name, c.edfi_column_name,
   count(r.id) num_matches, count(*) num_rows, count(r.id)/count(*) match_rate
   from sids s cross join cols c left join rids r on r.edfi_column_name=c.edfi_column_name and r.id=s.id group by all)""",
    "orgs": """
conn as (select case when s_suppkey%13=12 then 'other' else 'edfi' end||'_n_'||s_nationkey||'_2024_'||s_suppkey connection_id,
   case when s_suppkey%17=16 then 'connection refused' end error, s_suppkey k, s_nationkey nk,
   'n_'||s_nationkey tenant, '2024' as year,
   case when s_nationkey<>7 then 'L'||s_nationkey end expected from supplier where s_suppkey%13<>12),
listed as (select k, nk, l_partkey, l_returnflag from conn join lineitem on l_suppkey=k where k%6>=4),
cal as (select distinct k, l_partkey from listed where l_returnflag='R' and k%12<>10),
via as (select cal.k, count(distinct lea) n_via, min(lea) lea from cal join (
          select distinct k, l_partkey, case when k%6=4 or l_partkey%2=0 then 'L'||nk else 'L_other' end lea from listed) s
          on s.k=cal.k and s.l_partkey=cal.l_partkey group by cal.k),
found as (select conn.*, n_via,
   case when k%6=0 then (case when 'L'||nk=coalesce(expected,'') then expected end)
        when k%6=1 then null when k%6=2 then null when k%6=3 then 'L'||nk
        when n_via=1 then via.lea end actual,
   case when k%6=0 and 'L'||nk=coalesce(expected,'') then 'token' when k%6 in (0,1) then 'token_differs' when k%6=2 then 'token_many'
        when k%6=3 then 'agencies' when n_via=1 then 'schools' else 'none' end meth,
   case when k%6 in (0,1) then 1 when k%6=2 then 2 else 0 end n_token_ids, case when k%6=3 then 1 else 0 end n_leas
   from conn left join via using (k)),
results as (select connection_id, tenant, year, expected expected_lea_id,
   case when error is null then actual end actual_org_id, case when error is null then meth else 'error' end method_used,
   case when error is not null then 'ERROR' when expected is null then 'NO_MAPPING' when actual is null then 'NO_ORG_ID'
        when actual=expected then 'MATCH' else 'MISMATCH' end status,
   case when error is not null then error else concat_ws(' ', 'wanted='||expected, 'seen='||actual, 'step='||meth) end message,
   n_token_ids, n_leas, n_via n_via_schools from found)""",
}


def with_views(*names: str) -> str:
    return "with " + ",".join(SQL[name] for name in names) + "\n"
