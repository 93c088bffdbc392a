"""quire.sources"""
