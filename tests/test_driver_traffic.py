"""What the driver is sent: tables that grow with the data are joined by shuffles."""
import re

from caresight.sources.adapters import Inputs
from caresight.sources.tables import Owned

SF = "/root/testdata/sf0.001"


def test_provider_tables_are_not_sent_to_the_driver(spark):
    """Tables that grow with the providers are joined by shuffles, however small they are found to be."""
    from caresight.plans.alerts import AlertReport
    with Owned() as own:
        rows = AlertReport(Inputs(spark, SF), "2023-12-31", "2024-01-31", ["Alice", "Bob"]).report_base.select("NpiId", "TIN", "ProviderConsultant")
        rows.write.format("noop").mode("overwrite").save()
        assert rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        joins = [x for x in plan.splitlines() if "BroadcastHashJoin" in x]
        assert not [x for x in joins if re.search(r"NpiNum|TIN|NPI", x)]
    own.release()
