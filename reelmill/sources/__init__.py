"""Where rows come from: listings, manifests, lists and split files."""
