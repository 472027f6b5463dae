"""The same jobs as streams over growing folders, run until nothing new is left."""
