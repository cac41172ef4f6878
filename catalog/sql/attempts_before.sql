select rider_id, count(*) as attempts, max(dispatch_time) as last_dispatch
from {task}
where dispatch_time < cast(:as_of as timestamp_ntz)
group by rider_id
