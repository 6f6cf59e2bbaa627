"""Reading pages, feeds and watchlists; writing dated tables."""
