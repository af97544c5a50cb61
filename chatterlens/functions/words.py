"""Word lists. Results depend on exactly these entries."""

BULLISH_WORDS = (
    "bull bullish buy buying call long breakout target upward rally profit "
    "gain green ce upside support ath high moon boom strong"
).split()

BEARISH_WORDS = (
    "bear bearish sell selling put short crash dump downward fall loss red pe "
    "downside resistance breakdown low panic drop stoploss weak"
).split()

# Spark's default English stop words, without its contractions: a token never holds an apostrophe.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "a an the and but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now "
    "cannot could ought would"
).split()
