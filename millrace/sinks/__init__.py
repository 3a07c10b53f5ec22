"""Where rows go."""
