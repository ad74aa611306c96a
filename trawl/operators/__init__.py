"""DataFrame -> DataFrame operators: index build, search, crawl frontier and stats."""
