"""Where records come from: topics, declared tables, dimension tables, shop tables."""
