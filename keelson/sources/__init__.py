"""Sources: landed page bodies, rows from them."""

from keelson.sources.pages import (derived_table, nested_array_rows, page_chain, stop_at_short_page,
                                   unnest_list, unnest_results)

__all__ = ["derived_table", "nested_array_rows", "page_chain", "stop_at_short_page",
           "unnest_list", "unnest_results"]
