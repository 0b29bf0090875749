"""All registered queries."""

from slipstream.plans import asof_queries, catalog_queries, feed_queries, keyframe_queries
from slipstream.plans.feed_queries import Query

QUERIES: dict[str, Query] = {
    **feed_queries.QUERIES,
    **asof_queries.QUERIES,
    **keyframe_queries.QUERIES,
    **catalog_queries.QUERIES,
}
