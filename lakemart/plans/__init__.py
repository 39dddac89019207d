"""Jobs: silver and gold builders, the warehouse load, the crawl frontier and the run report."""
