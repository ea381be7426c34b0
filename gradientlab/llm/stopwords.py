"""Frequent function words, by language.

Fixed values: common words of each language, as any grammar lists them.
"""

WORDS = {
    "en": "the a an and or but if of to in on at by for from with as is are was were be been it its this that these those "
          "he she they we you i his her their our your not no so than then there which who what when where how all any "
          "can will would could should has have had do does did about into over after before also only such",
    "de": "der die das den dem des ein eine einer eines einem einen und oder aber wenn von zu im in an auf bei mit aus für "
          "als ist sind war waren sein es er sie wir ihr ich nicht kein so wie auch nur noch nach vor über unter durch sich "
          "dass was wer wo hat haben hatte wird werden kann man am zum zur vom beim um bis",
    "fr": "le la les l un une des du de d et ou mais si à au aux en dans sur sous par pour avec sans est sont était être "
          "il elle ils elles nous vous je on ce cet cette ces qui que quoi dont où ne pas plus se sa son ses leur leurs "
          "a ont avait comme tout tous aussi entre",
    "es": "el la los las un una unos unas y o pero si de del al a en con sin por para sobre entre es son era ser está que "
          "quien cual como cuando donde no se su sus le les lo me te nos mi tu este esta estos estas ese esa más muy ya "
          "también ha han había hay fue todo todos",
}
ALL = frozenset(w for words in WORDS.values() for w in words.split())
